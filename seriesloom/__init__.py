"""Series indices over instance-level imaging metadata, as Spark DataFrame functions."""

from .plans.core import (
    analysis_results_index,
    clinical_index,
    collections_index,
    latest_version,
    series_index,
    version_metadata_index,
    version_span,
)
from .plans.derived import ann_group_index, ann_index, rtstruct_index, seg_index
from .plans.geometry import slice_intervals, slice_positions, volume_geometry_index
from .plans.mapping import (
    checked_mapping,
    column_subset,
    cross_catalogue_mapping,
    study_selection,
    write_mapping,
)
from .plans.modality import contrast_index, ct_index, mr_index, pt_index
from .plans.registry import INDEXES, build, dictionary, publish
from .plans.slide import sm_index, sm_instance_index
from .plans.versions import prior_versions_index, update_history
from .sources.tables import Tables

__all__ = [
    "INDEXES",
    "Tables",
    "analysis_results_index",
    "ann_group_index",
    "ann_index",
    "build",
    "checked_mapping",
    "clinical_index",
    "collections_index",
    "column_subset",
    "contrast_index",
    "cross_catalogue_mapping",
    "ct_index",
    "dictionary",
    "latest_version",
    "mr_index",
    "prior_versions_index",
    "pt_index",
    "publish",
    "rtstruct_index",
    "seg_index",
    "series_index",
    "slice_intervals",
    "slice_positions",
    "sm_index",
    "sm_instance_index",
    "study_selection",
    "update_history",
    "version_metadata_index",
    "version_span",
    "volume_geometry_index",
    "write_mapping",
]
