from seriesloom import contrast_index, ct_index, mr_index, pt_index
from seriesloom.lookups import CT_CLASS, MR_CLASS, PT_CLASS

from .support import by, code, instances


def test_ct_extremes_and_any_values(spark):
    rows = [
        {"SeriesInstanceUID": "a", "SOPClassUID": CT_CLASS, "XRayTubeCurrent": "100", "KVP": "120",
         "PixelSpacing": ["0.7", "0.8"], "ConvolutionKernel": ["B30f"], "Exposure": "bad"},
        {"SeriesInstanceUID": "a", "SOPClassUID": CT_CLASS, "XRayTubeCurrent": "90", "KVP": None,
         "PixelSpacing": []},
        {"SeriesInstanceUID": "b", "SOPClassUID": MR_CLASS, "XRayTubeCurrent": "1"},
    ]
    (got,) = ct_index(instances(spark, rows)).collect()
    assert (got.XRayTubeCurrent_min, got.XRayTubeCurrent_max) == (90.0, 100.0)
    assert (got.PixelSpacing_row_mm, got.PixelSpacing_col_mm) == (0.7, 0.8)
    assert got.KVP == 120.0 and got.ConvolutionKernel == ["B30f"] and got.ScanOptions == []
    assert got.Exposure_min is None and got.SpiralPitchFactor is None


def test_mr_sorted_distinct_numbers(spark):
    rows = [
        {"SeriesInstanceUID": "a", "SOPClassUID": MR_CLASS, "EchoTime": e, "DiffusionBValue": b,
         "EchoTrainLength": n}
        for e, b, n in [("10", 1000.0, "3.5"), ("9", 0.0, None), ("9.0", None, "2"), ("x", 0.0, None)]
    ] + [{"SeriesInstanceUID": "b", "SOPClassUID": MR_CLASS}]
    got = by(mr_index(instances(spark, rows)), "SeriesInstanceUID")
    assert got["a"].EchoTime == [9.0, 10.0] and got["a"].DiffusionBValue == [0.0, 1000.0]
    assert got["a"].EchoTrainLength == 2
    assert got["b"].EchoTime == [] and got["b"].DiffusionBValue == []


def test_pt_nested_first_elements(spark):
    agent = {
        "RadionuclideCodeSequence": [code("1", "F18"), code("2", "Ga68")],
        "RadionuclideTotalDose": "3.5e8",
        "RadiopharmaceuticalStartTime": "10:11:12",
        "Radiopharmaceutical": "FDG",
    }
    rows = [
        {"SeriesInstanceUID": "a", "SOPClassUID": PT_CLASS, "SeriesType": ["WHOLE BODY", "IMAGE"],
         "RadiopharmaceuticalInformationSequence": [agent], "ActualFrameDuration": "60000"},
        {"SeriesInstanceUID": "b", "SOPClassUID": PT_CLASS},
    ]
    got = by(pt_index(instances(spark, rows)), "SeriesInstanceUID")
    assert got["a"].SeriesType == "WHOLE BODY/IMAGE" and got["a"].RadionuclideCodeMeaning == "F18"
    assert got["a"].RadionuclideTotalDose == 3.5e8
    assert got["a"].RadiopharmaceuticalStartTime == "10:11:12"
    assert got["a"].ActualFrameDuration == [60000.0]
    assert got["b"].SeriesType == "" and got["b"].Radiopharmaceutical is None


def test_contrast_keeps_series_with_any(spark):
    rows = [
        {"SeriesInstanceUID": "a", "Modality": "CT", "ContrastBolusAgent": "Z"},
        {"SeriesInstanceUID": "a", "Modality": "CT", "ContrastBolusAgent": "A"},
        {"SeriesInstanceUID": "b", "Modality": "CT"},
        {"SeriesInstanceUID": "c", "Modality": "RF", "ContrastBolusRoute": "IV"},
        {"SeriesInstanceUID": "d", "Modality": "US", "ContrastBolusAgent": "A"},
    ]
    got = by(contrast_index(instances(spark, rows)), "SeriesInstanceUID")
    assert set(got) == {"a", "c"}
    assert got["a"].ContrastBolusAgent == ["A", "Z"] and got["a"].ContrastBolusRoute == []
    assert got["c"].ContrastBolusRoute == ["IV"]
