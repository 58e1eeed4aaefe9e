import pytest

from panelyard.operators import cohort as H
from panelyard.operators import curate as C

SCHEMA = "target string, structure string, molecule_id string, assay_id string, type string, value string, units string, relation string, direct_value string, validity_comment string, activity_comment string, year int, pos bigint"


def rows(spark, *given):
    base = dict(target="T", structure="CCO", molecule_id="M1", assay_id="A", type="IC50", value="100", units="nM", relation="=", direct_value=None, validity_comment=None, activity_comment=None, year=2000, pos=0)
    return spark.createDataFrame([tuple((base | g | {"pos": i})[c.split()[0]] for c in SCHEMA.split(", ")) for i, g in enumerate(given)], SCHEMA)


def test_units_that_mean_the_same(spark):
    got = C.curated_rows(rows(spark, {}, {"value": "0.1", "units": " uM "}, {"value": "1e-4", "units": "MM"}, {"value": "5", "units": "furlong"})).collect()
    assert [round(r["label"], 6) for r in got] == [7.0, 7.0, 7.0]


@pytest.mark.parametrize(
    ("change", "kept"),
    [({"validity_comment": "Outside range"}, 0), ({"validity_comment": "nan"}, 1), ({"activity_comment": " Inactive"}, 0), ({"activity_comment": None}, 1), ({"relation": ">"}, 0), ({"relation": None}, 1), ({"relation": ">", "direct_value": "6.5"}, 1),
     ({"type": "Ki", "direct_value": "6.5"}, 0), ({"type": "ic50"}, 1), ({"value": "x"}, 0), ({"value": "Infinity"}, 0), ({"value": "0"}, 0), ({"direct_value": "3"}, 1), ({"direct_value": "11.01"}, 0), ({"structure": None}, 0)],
)
def test_keep_rule(spark, change, kept):
    assert C.curated_rows(rows(spark, change)).count() == kept


def test_panel_eras_and_first_id(spark):
    made = C.panel(C.curated_rows(rows(spark, {"molecule_id": None, "year": 1990, "direct_value": "5"}, {"molecule_id": "M2", "direct_value": "7"}, {"molecule_id": "M3", "year": None, "direct_value": "9"})), 1995).collect()
    assert len(made) == 1
    r = made[0]
    assert (r["label"], r["n"], r["molecule_id"], r["label_pre"], r["n_pre"], r["label_post"], r["n_post"]) == (7.0, 3, "M2", 5.0, 1, 7.0, 1)


def test_wide_panel_skips_nulls(spark):
    p = spark.createDataFrame([("T0", "a", 7.0, 1), ("T1", "a", 5.0, 1), ("T0", "b", 6.0, 1)], "target string, structure string, label double, n long")
    got = {r["structure"]: r for r in C.wide_panel(p, "T0", ["T1", "T2"]).collect()}
    assert got["a"]["delta_min"] == 2.0 and got["a"]["delta_T0_T2"] is None and got["b"]["delta_min"] is None


def test_header(spark):
    df = spark.createDataFrame([("x", "y", "z", 1)], ["Standard Type ", "canonical_smiles", "standard_type", "document_year"])
    got = C.standard_header(df)
    assert got.columns[:3] == ["type", "structure", "year"] and set(C.NEEDED) <= set(got.columns)
    assert got.first()["type"] == "x"


def test_contract(spark):
    good = spark.createDataFrame([("a", 5.0)], "structure string, label double")
    assert C.require_contract(good) is good
    with pytest.raises(ValueError, match="label_high"):
        C.require_contract(good.union(spark.createDataFrame([("b", 12.0)], good.schema)))


def test_guards(spark):
    with pytest.raises(ValueError):
        C.require_known_assays("biochemical_explicit", None)
    C.require_known_assays("target_associated", None)
    with pytest.raises(ValueError):
        H.apply_to_activities(spark.range(1), spark.range(1))
    with pytest.raises(ValueError):
        H.resolved("nothing")
    assert H.resolved("domain1_biochemical_explicit").accept == ("domain_1",)


def test_empty_activity(spark):
    none = rows(spark)
    assert C.panel(C.curated_rows(none), 2000).count() == 0
    assert {r["n"] for r in C.violations(spark.createDataFrame([], "structure string, label double")).collect()} == {0}


@pytest.mark.parametrize(
    ("text", "label"),
    [("Inhibition of BD1 in HeLa cells", "cell_based"), ("binding to BRD4 BD1 by HTRF", "domain_1"), ("second bromodomain", "domain_2"), ("full-length protein", "full_length"), ("JH2 domain", "pseudokinase"), ("recombinant enzyme", "biochemical"), ("something", "unmatched"), (None, "no_description"), ("nan", "no_description"), ("", "no_description")],
)
def test_classes(spark, text, label):
    assay = spark.createDataFrame([("A", text, "BAO_0000357", "B")], "assay_id string, description string, bao_format string, assay_type string")
    assert H.select_assays(assay, H.COHORTS["target_associated"]).first()["label"] == label


def test_structured_reasons_differ(spark):
    made = [("ok", "BD1 binding", "BAO_0000357", "B"), ("tandem", "BD1/BD2 binding, bd1", "BAO_0000357", "B"), ("cell", "BD1", "BAO_0000219", "B"), ("root", "BD1", "BAO_0000019", "B"), ("none", "BD1", None, "B"), ("type", "BD1", "BAO_0000357", "A"), ("notype", "BD1", "BAO_0000357", None)]
    df = spark.createDataFrame(made, "assay_id string, description string, bao_format string, assay_type string")
    got = {r["assay_id"]: r["reason"] for r in H.select_assays(df, H.COHORTS["domain1_bd1_explicit_structured_binding"]).collect()}
    assert got["ok"] is None and len(set(got.values())) == len(made)


def test_borders_of_captured_patterns_are_ascii(spark):
    texts = ["\u00e9und die Katze", "xund die Katze", "und die\u00df, Und die", "_und die", "BD1 a\\bb", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    assert [r[0] for r in df.orderBy("id").select(H.captured(df["text"], r"(\bund die\b)")).collect()] == ["und die", "", "und die", "", "", ""]
    assert [r[0] for r in df.orderBy("id").select(H.captured(df["text"], r"(a\\bb)")).collect()] == ["", "", "", "", "a\\bb", ""]
