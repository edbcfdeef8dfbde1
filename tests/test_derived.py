from seriesloom import ann_group_index, ann_index, rtstruct_index, seg_index
from seriesloom.lookups import ANN_CLASS, CT_CLASS, RTSTRUCT_CLASS, SEG_CLASS

from .support import by, code, instances


def seg(series, sop, segments, **more):
    return {
        "SeriesInstanceUID": series,
        "SOPInstanceUID": sop,
        "Modality": "SEG",
        "SOPClassUID": SEG_CLASS,
        "SegmentationType": "BINARY",
        "SegmentSequence": segments,
        **more,
    }


def segment(number, **more):
    return {"SegmentNumber": number, "SegmentAlgorithmType": "MANUAL", **more}


def listed(sop):
    return {"ReferencedSeriesSequence": [{"ReferencedInstanceSequence": [{"ReferencedSOPInstanceUID": sop}]}]}


def image(sop):
    return {"ReferencedImageSequence": [{"ReferencedSOPInstanceUID": sop}]}


def source(sop):
    return {"SourceImageSequence": [{"ReferencedSOPInstanceUID": sop}]}


def test_segmented_series_over_three_paths(spark):
    rows = [
        {"SeriesInstanceUID": f"ct{i}", "SOPInstanceUID": f"i{i}", "SOPClassUID": CT_CLASS}
        for i in (1, 2, 3)
    ] + [
        seg("by_list", "a", [segment(1)], **listed("i1")),
        seg("by_image", "b", [segment(1)], **image("i2")),
        seg("by_source", "c", [segment(1)], **source("i3")),
        seg("two_paths", "d", [segment(1)], **image("i2"), **source("i3")),
        seg("broken_first", "e", [segment(1)], **listed("gone"), **source("i3")),
        seg("none", "f", [segment(1)]),
        seg("no_segments", "g", [], **listed("i1")),
        seg("mixed", "h", [segment(1)]),
        seg("mixed", "h2", [], **listed("i1")),  # has no segment to attach the reference to
    ]
    got = by(seg_index(instances(spark, rows)), "SeriesInstanceUID")
    found = {k: r.segmented_SeriesInstanceUID for k, r in got.items()}
    assert found == {
        "by_list": "ct1", "by_image": "ct2", "by_source": "ct3", "two_paths": "ct2",
        "broken_first": None, "none": None, "mixed": None,
    }


def test_segments_are_distinct_per_series(spark):
    rows = [
        seg("s", "a", [
            segment(1, SegmentAlgorithmName=["net", "x"],
                    SegmentedPropertyTypeCodeSequence=[code("1", "Liver")],
                    AnatomicRegionSequence=[code("r", "Abdomen")]),
            segment(2, SegmentAlgorithmType="AUTOMATIC",
                    SegmentedPropertyTypeCodeSequence=[code("2", "Kidney"), code("9", "Ignored")]),
        ]),
        seg("s", "b", [segment(2, SegmentAlgorithmName=["ace"],
                               SegmentedPropertyCategoryCodeSequence=[code("c", "Organ")])]),
    ]
    (got,) = seg_index(instances(spark, rows)).collect()
    assert got.total_segments == 2 and got.AlgorithmType == "AUTOMATIC,MANUAL"
    assert got.AlgorithmName == "ace,net"
    assert got.SegmentedPropertyType_CodeMeanings == ["Kidney", "Liver"]
    assert got.SegmentedPropertyCategory_CodeMeanings == ["Organ"]
    assert got.AnatomicRegion_CodeMeanings == ["Abdomen"]


def test_structure_set_fan_out(spark):
    def frames(*series):
        return [{"RTReferencedStudySequence": [{"RTReferencedSeriesSequence": [{"SeriesInstanceUID": s} for s in series]}]}]

    rows = [
        {"SeriesInstanceUID": "s", "SOPInstanceUID": "a", "SOPClassUID": RTSTRUCT_CLASS,
         "StructureSetROISequence": [
             {"ROINumber": 1, "ROIName": "GTV", "ROIGenerationAlgorithm": "MANUAL"},
             {"ROINumber": 2, "ROIName": "Heart"}],
         "RTROIObservationsSequence": [
             {"ReferencedROINumber": 1, "RTROIInterpretedType": "GTV"},
             {"ReferencedROINumber": 1, "RTROIInterpretedType": "ORGAN"},
             {"ReferencedROINumber": 7, "RTROIInterpretedType": "LOST"}],
         "ReferencedFrameOfReferenceSequence": frames("ct2", "ct1")},
        {"SeriesInstanceUID": "plain", "SOPInstanceUID": "b", "SOPClassUID": RTSTRUCT_CLASS,
         "StructureSetROISequence": [{"ROINumber": 5, "ROIName": None}]},
        {"SeriesInstanceUID": "empty", "SOPInstanceUID": "c", "SOPClassUID": RTSTRUCT_CLASS,
         "ReferencedFrameOfReferenceSequence": frames("ct9")},
    ]
    got = by(rtstruct_index(instances(spark, rows)), "SeriesInstanceUID")
    assert set(got) == {"s", "plain"}
    s = got["s"]
    assert s.total_rois == 2 and s.ROINames == ["GTV", "Heart"]
    assert s.ROIGenerationAlgorithms == ["MANUAL"] and s.RTROIInterpretedTypes == ["GTV", "ORGAN"]
    assert s.referenced_SeriesInstanceUID == "ct1"
    assert got["plain"].total_rois == 1 and got["plain"].ROINames == []
    assert got["plain"].referenced_SeriesInstanceUID is None


def test_annotations(spark):
    rows = [
        {"SeriesInstanceUID": "s", "SOPClassUID": ANN_CLASS, "AnnotationCoordinateType": "2D",
         "ReferencedSeriesSequence": [{"SeriesInstanceUID": "sm1"}, {"SeriesInstanceUID": "sm2"}],
         "AnnotationGroupSequence": [
             {"AnnotationGroupNumber": 1, "NumberOfAnnotations": 10,
              "AnnotationPropertyCategoryCodeSequence": [code("1", "Cell")],
              "AnnotationPropertyTypeCodeSequence": [code("2", "Nucleus", scheme=None)],
              "AnnotationGroupAlgorithmIdentificationSequence": [{"AlgorithmName": "net"}]},
             {"AnnotationGroupNumber": 2}]},
        {"SeriesInstanceUID": "t", "SOPClassUID": ANN_CLASS},
    ]
    df = instances(spark, rows)
    series = by(ann_index(df), "SeriesInstanceUID")
    assert series["s"].referenced_SeriesInstanceUID == "sm1"
    assert series["t"].referenced_SeriesInstanceUID is None
    groups = by(ann_group_index(df), "AnnotationGroupNumber")
    assert set(groups) == {1, 2} and groups[1].AlgorithmName == "net"
    assert groups[1].AnnotationPropertyCategory_code == "SCT:1"
    assert groups[1].AnnotationPropertyType_code is None
    assert groups[1].AnnotationPropertyType_CodeMeaning == "Nucleus"
    assert groups[2].AnnotationPropertyCategory_code is None
