from seriesloom import sm_index, sm_instance_index

from .support import by, code, instances

EMBEDDING, FIXATIVE, STAIN = "430863003", "430864009", "424361007"


def item(names, codes):
    return {"ConceptNameCodeSequence": names, "ConceptCodeSequence": codes}


def specimen(*items, **more):
    steps = [{"SpecimenPreparationStepContentItemSequence": list(items)}]
    return {"SpecimenDescriptionSequence": [{"SpecimenPreparationSequence": steps, **more}]}


def name(value, scheme="SCT"):
    return code(value, "whatever", scheme=scheme)


def slide(sop, series="s", **more):
    return {"SeriesInstanceUID": series, "SOPInstanceUID": sop, "Modality": "SM", **more}


def test_specimen_lists(spark):
    rows = [
        slide("1", **specimen(
            item([name(STAIN), name(EMBEDDING)], [code("2", "Water"), code("1", "Eosin")]),
            item([name(FIXATIVE, "OTHER")], [code("9", "wrong scheme")]),
            item([name(FIXATIVE)], []),
            item([], [code("8", "no name")]))),
        slide("2", **specimen(item([name(STAIN)], [code("1", "Eosin"), code("3", None)]))),
        slide("3", "empty"),
        {"SeriesInstanceUID": "ct", "SOPInstanceUID": "4", "Modality": "CT",
         **specimen(item([name(STAIN)], [code("1", "Eosin")]))},
    ]
    df = instances(spark, rows)
    by_series = by(sm_index(df), "SeriesInstanceUID")
    assert set(by_series) == {"s", "empty"}
    s = by_series["s"]
    assert s.staining_usingSubstance_CodeMeaning == ["Eosin", "Water"]
    assert s.staining_usingSubstance_code_designator_value_str == ["SCT:1", "SCT:2"]
    assert s.embeddingMedium_CodeMeaning == ["Eosin", "Water"]
    assert s.tissueFixative_CodeMeaning == []
    assert by_series["empty"].staining_usingSubstance_CodeMeaning == []
    one = by(sm_instance_index(df), "SOPInstanceUID")
    assert set(one) == {"1", "2", "3"}
    assert one["2"].staining_usingSubstance_CodeMeaning == ["Eosin"]
    assert one["3"].embeddingMedium_code_designator_value_str == []


def test_meaning_with_a_colon_is_kept_whole(spark):
    rows = [slide("1", **specimen(item([name(STAIN)], [code("1", "H: E")])))]
    (got,) = sm_index(instances(spark, rows)).collect()
    assert got.staining_usingSubstance_CodeMeaning == ["H: E"]
    assert got.staining_usingSubstance_code_designator_value_str == ["SCT:1"]


def test_series_values(spark):
    anatomy = [code("a2", "Lung", PrimaryAnatomicStructureModifierSequence=[code("m", "Left")])]
    rows = [
        slide("1", PixelSpacing=["0.000252", "1"], TotalPixelMatrixColumns=10, Columns=99, Rows=7,
              ContainerIdentifier="box",
              OpticalPathSequence=[{"ObjectiveLensPower": "40", "IlluminationTypeCodeSequence": [code("i", "Bright", scheme="DCM")]}],
              **specimen(PrimaryAnatomicStructureSequence=anatomy)),
        slide("2", PixelSpacing=["0.5", "1"], TotalPixelMatrixColumns=30, Rows=9,
              SharedFunctionalGroupsSequence=[{"PixelMeasuresSequence": [{"PixelSpacing": ["0.1"]}]}],
              AdmittingDiagnosesCodeSequence=[code("d", "Tumor")],
              **specimen(PrimaryAnatomicStructureSequence=[code("a1", None)])),
        slide("3", "shared", SharedFunctionalGroupsSequence=[{"PixelMeasuresSequence": [{"PixelSpacing": ["0"]}]}]),
    ]
    got = by(sm_index(instances(spark, rows)), "SeriesInstanceUID")
    s = got["s"]
    assert s.min_PixelSpacing_2sf == 0.00025 and s.ObjectiveLensPower == 40
    assert s.max_TotalPixelMatrixColumns == 30 and s.max_TotalPixelMatrixRows == 9
    assert s.primaryAnatomicStructure_code_designator_value_str == "SCT:a2"
    assert s.primaryAnatomicStructure_CodeMeaning == "Lung"
    assert s.primaryAnatomicStructureModifier_CodeMeaning == "Left"
    assert s.illuminationType_code_designator_value_str == "DCM:i"
    assert s.admittingDiagnosis_CodeMeaning == "Tumor" and s.ContainerIdentifier == "box"
    assert got["shared"].min_PixelSpacing_2sf == 0.0
    assert got["shared"].primaryAnatomicStructure_CodeMeaning is None
