"""Names, identifiers and mappings that results must agree on."""

from __future__ import annotations

# Fixed values of the DICOM standard: storage SOP class UID -> name.
SOP_CLASS_NAMES: dict[str, str] = {
    "1.2.840.10008.5.1.4.1.1.1": "Computed Radiography Image Storage",
    "1.2.840.10008.5.1.4.1.1.1.1": "Digital X-Ray Image Storage - For Presentation",
    "1.2.840.10008.5.1.4.1.1.1.1.1": "Digital X-Ray Image Storage - For Processing",
    "1.2.840.10008.5.1.4.1.1.1.2": "Digital Mammography X-Ray Image Storage - For Presentation",
    "1.2.840.10008.5.1.4.1.1.1.2.1": "Digital Mammography X-Ray Image Storage - For Processing",
    "1.2.840.10008.5.1.4.1.1.104.3": "Encapsulated STL Storage",
    "1.2.840.10008.5.1.4.1.1.11.1": "Grayscale Softcopy Presentation State Storage",
    "1.2.840.10008.5.1.4.1.1.11.8": "Advanced Blending Presentation State Storage",
    "1.2.840.10008.5.1.4.1.1.12.1": "X-Ray Angiographic Image Storage",
    "1.2.840.10008.5.1.4.1.1.12.2": "X-Ray Radiofluoroscopic Image Storage",
    "1.2.840.10008.5.1.4.1.1.128": "Positron Emission Tomography Image Storage",
    "1.2.840.10008.5.1.4.1.1.13.1.3": "Breast Tomosynthesis Image Storage",
    "1.2.840.10008.5.1.4.1.1.13.1.4": "Breast Projection X-Ray Image Storage - For Presentation",
    "1.2.840.10008.5.1.4.1.1.13.1.5": "Breast Projection X-Ray Image Storage - For Processing",
    "1.2.840.10008.5.1.4.1.1.2": "CT Image Storage",
    "1.2.840.10008.5.1.4.1.1.20": "Nuclear Medicine Image Storage",
    "1.2.840.10008.5.1.4.1.1.3.1": "Ultrasound Multi-frame Image Storage",
    "1.2.840.10008.5.1.4.1.1.30": "Parametric Map Storage",
    "1.2.840.10008.5.1.4.1.1.4": "MR Image Storage",
    "1.2.840.10008.5.1.4.1.1.481.2": "RT Dose Storage",
    "1.2.840.10008.5.1.4.1.1.481.3": "RT Structure Set Storage",
    "1.2.840.10008.5.1.4.1.1.481.5": "RT Plan Storage",
    "1.2.840.10008.5.1.4.1.1.6.1": "Ultrasound Image Storage",
    "1.2.840.10008.5.1.4.1.1.66": "Raw Data Storage",
    "1.2.840.10008.5.1.4.1.1.66.1": "Spatial Registration Storage",
    "1.2.840.10008.5.1.4.1.1.66.4": "Segmentation Storage",
    "1.2.840.10008.5.1.4.1.1.67": "Real World Value Mapping Storage",
    "1.2.840.10008.5.1.4.1.1.7": "Secondary Capture Image Storage",
    "1.2.840.10008.5.1.4.1.1.7.2": "Multi-frame Grayscale Byte Secondary Capture Image Storage",
    "1.2.840.10008.5.1.4.1.1.77.1.6": "VL Whole Slide Microscopy Image Storage",
    "1.2.840.10008.5.1.4.1.1.88.22": "Enhanced SR Storage",
    "1.2.840.10008.5.1.4.1.1.88.33": "Comprehensive SR Storage",
    "1.2.840.10008.5.1.4.1.1.88.34": "Comprehensive 3D SR Storage",
    "1.2.840.10008.5.1.4.1.1.88.59": "Key Object Selection Document Storage",
    "1.2.840.10008.5.1.4.1.1.88.67": "X-Ray Radiation Dose SR Storage",
    "1.2.840.10008.5.1.4.1.1.88.71": "Acquisition Context SR Storage",
    "1.2.840.10008.5.1.4.1.1.91.1": "Microscopy Bulk Simple Annotations Storage",
}

# Fixed values of the DICOM standard: transfer syntax UID -> name.
TRANSFER_SYNTAX_NAMES: dict[str, str] = {
    "1.2.840.10008.1.2": "Implicit VR Little Endian",
    "1.2.840.10008.1.2.1": "Explicit VR Little Endian",
    "1.2.840.10008.1.2.2": "Explicit VR Big Endian",
    "1.2.840.10008.1.2.4.50": "JPEG Baseline",
    "1.2.840.10008.1.2.4.51": "JPEG Extended",
    "1.2.840.10008.1.2.4.70": "JPEG Lossless",
    "1.2.840.10008.1.2.4.80": "JPEG-LS Lossless",
    "1.2.840.10008.1.2.4.90": "JPEG 2000 Lossless",
    "1.2.840.10008.1.2.4.91": "JPEG 2000",
}

# SOP classes the builders select on.
CT_CLASS = "1.2.840.10008.5.1.4.1.1.2"
MR_CLASS = "1.2.840.10008.5.1.4.1.1.4"
PT_CLASS = "1.2.840.10008.5.1.4.1.1.128"
SEG_CLASS = "1.2.840.10008.5.1.4.1.1.66.4"
RTSTRUCT_CLASS = "1.2.840.10008.5.1.4.1.1.481.3"
ANN_CLASS = "1.2.840.10008.5.1.4.1.1.91.1"

# Modalities that may carry a contrast agent.
CONTRAST_MODALITIES = ("CT", "MR", "PT", "XA", "RF")

# Specimen preparation concepts (coding scheme, code).
PREPARATION_CONCEPTS: dict[str, tuple[str, str]] = {
    "embeddingMedium": ("SCT", "430863003"),
    "tissueFixative": ("SCT", "430864009"),
    "staining_usingSubstance": ("SCT", "424361007"),
}

# Storage bucket -> mirror bucket, and buckets left out of the history.
MIRROR_BUCKETS: dict[str, str] = {
    "public-datasets-idc": "idc-open-data",
    "idc-open-idc1": "idc-open-data-two",
    "idc-open-cr": "idc-open-data-cr",
}
EXCLUDED_BUCKETS = ("idc-open-idc",)

# LIKE patterns of the collections shared with the case catalogue.
SHARED_COLLECTION_PATTERNS = (
    "tcga%",
    "%apollo%",
    "%cptac%",
    "%ccdi%",
    "cgci%",
    "cddp_eagle%",
    "hcmi%",
)

# Collection -> projects of the case catalogue.
COLLECTION_PROJECTS: dict[str, list[str]] = {
    "tcga_acc": ["TCGA-ACC"],
    "tcga_blca": ["TCGA-BLCA"],
    "tcga_brca": ["TCGA-BRCA"],
    "tcga_cesc": ["TCGA-CESC"],
    "tcga_chol": ["TCGA-CHOL"],
    "tcga_coad": ["TCGA-COAD"],
    "tcga_dlbc": ["TCGA-DLBC"],
    "tcga_esca": ["TCGA-ESCA"],
    "tcga_gbm": ["TCGA-GBM"],
    "tcga_hnsc": ["TCGA-HNSC"],
    "tcga_kich": ["TCGA-KICH"],
    "tcga_kirc": ["TCGA-KIRC"],
    "tcga_kirp": ["TCGA-KIRP"],
    "tcga_lgg": ["TCGA-LGG"],
    "tcga_lihc": ["TCGA-LIHC"],
    "tcga_luad": ["TCGA-LUAD"],
    "tcga_lusc": ["TCGA-LUSC"],
    "tcga_meso": ["TCGA-MESO"],
    "tcga_ov": ["TCGA-OV"],
    "tcga_paad": ["TCGA-PAAD"],
    "tcga_pcpg": ["TCGA-PCPG"],
    "tcga_prad": ["TCGA-PRAD"],
    "tcga_read": ["TCGA-READ"],
    "tcga_sarc": ["TCGA-SARC"],
    "tcga_skcm": ["TCGA-SKCM"],
    "tcga_stad": ["TCGA-STAD"],
    "tcga_tgct": ["TCGA-TGCT"],
    "tcga_thca": ["TCGA-THCA"],
    "tcga_thym": ["TCGA-THYM"],
    "tcga_ucec": ["TCGA-UCEC"],
    "tcga_ucs": ["TCGA-UCS"],
    "tcga_uvm": ["TCGA-UVM"],
    "cptac_aml": ["CPTAC-2", "CPTAC-3"],
    "cptac_brca": ["CPTAC-2", "CPTAC-3"],
    "cptac_ccrcc": ["CPTAC-2", "CPTAC-3"],
    "cptac_cm": ["CPTAC-2", "CPTAC-3"],
    "cptac_coad": ["CPTAC-2", "CPTAC-3"],
    "cptac_gbm": ["CPTAC-2", "CPTAC-3"],
    "cptac_hnscc": ["CPTAC-2", "CPTAC-3"],
    "cptac_lscc": ["CPTAC-2", "CPTAC-3"],
    "cptac_luad": ["CPTAC-2", "CPTAC-3"],
    "cptac_ov": ["CPTAC-2", "CPTAC-3"],
    "cptac_pda": ["CPTAC-2", "CPTAC-3"],
    "cptac_sar": ["CPTAC-2", "CPTAC-3"],
    "cptac_stad": ["CPTAC-2", "CPTAC-3"],
    "cptac_ucec": ["CPTAC-2", "CPTAC-3"],
    "ccdi_mci": ["CCDI-MCI"],
    "varepop_apollo": ["VAREPOP-APOLLO"],
    "cddp_eagle_1": ["CDDP_EAGLE-1"],
    "cgci_blgsp": ["CGCI-BLGSP"],
    "cgci_htmcp_cc": ["CGCI-HTMCP-CC"],
    "cgci_htmcp_dlbcl": ["CGCI-HTMCP-DLBCL"],
    "cgci_htmcp_lc": ["CGCI-HTMCP-LC"],
    "hcmi_cmdc": ["HCMI-CMDC"],
}

# Collections known to have no case in the catalogue.
COLLECTIONS_WITHOUT_CASES = ("cptac_cm", "cptac_sar")

# Columns of the download subset.
SUBSET_COLUMNS = (
    "collection_id",
    "PatientID",
    "StudyInstanceUID",
    "SeriesInstanceUID",
    "series_size_MB",
    "series_aws_url",
)
