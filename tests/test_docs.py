"""Document export edge rows."""

from namewright.plans import jobs

from .conftest import meta_row


def test_document_cases(tables):
    meta = [
        meta_row(1, "Provider", "is", "ACME"),
        meta_row(2, "Geography", "in", "FR", ric="1"), meta_row(2, "Geography", "of", "US"),
        meta_row(3, "Facility", "at", "Plant"),
        meta_row(4, "Unit", "was", "MWh"), meta_row(4, "Color", "is", "red"),
        meta_row(5, "FacilityType", "is", "Dam"),
        meta_row(7, "Provider", "is", "NotACurve", typ=2),
    ]
    names = [(1, 1, "N", "S", None), (1, 5, "a", "b", "c"), (2, 5, "d", "e", "f"), (1, 6, "x", "y", "z")]
    t = tables(meta, [], [], names=names)
    docs = jobs.build_docs(t["meta"], None, t["names"]).collect()
    by = {}
    for r in docs:
        by.setdefault(r["curve_id"], []).append(r["doc"])
    assert by[1] == ['<DOC id=1 TYPE="CDBTIMESERIES"><Permission>1</Permission><name>N</name>'
                     '<shortname>S</shortname><description>null</description><Provider>ACME</Provider></DOC>']
    assert by[2] == ['<DOC id=2 TYPE="CDBTIMESERIES"><Permission>2</Permission><Geography>FR|US</Geography>'
                     '<GeographyRCS>1|</GeographyRCS></DOC>']
    assert by[3] == ['<DOC id=3 TYPE="CDBTIMESERIES"><Permission>3</Permission><PhysicalAsset>Plant'
                     '</PhysicalAsset><PhysicalAssetRCS></PhysicalAssetRCS></DOC>']
    assert by[4] == ['<DOC id=4 TYPE="CDBTIMESERIES"><Permission>4</Permission></DOC>']
    assert len(by[5]) == 2 and all("<PhysicalAssetType>Dam</PhysicalAssetType>" in d for d in by[5])
    assert 6 not in by and 7 not in by


def test_scope_one_load_set(tables):
    meta = [meta_row(1, "Provider", "is", "A"), meta_row(2, "Provider", "is", "B")]
    names = [(1, 1, "n1", "s1", "d1"), (2, 1, "n1b", "s1b", "d1b"), (1, 2, "n2", "s2", "d2")]
    t = tables(meta, [(1, 1), (2, 2)], [], names=names)
    docs = jobs.build_docs(t["meta"], t["members"], t["names"], load_set_id=1).collect()
    assert [r["curve_id"] for r in docs] == [1]
    assert "<name>n1</name>" in docs[0]["doc"]


def test_clean_mode_is_well_formed(spark, tables):
    meta = [meta_row(1, "Provider", "is", "A&B <x>"), meta_row(1, "Geography", "in", 'G"1', ric="c&")]
    t = tables(meta, [], [], names=[(1, 1, None, "s", "d")])
    df = jobs.build_docs(t["meta"], None, t["names"], mode="clean")
    from pyspark.sql import functions as F
    got = df.select(F.xpath_string("doc", F.lit("/DOC/Provider")).alias("p"),
                    F.xpath_string("doc", F.lit("/DOC/@id")).alias("id"),
                    F.xpath_string("doc", F.lit("/DOC/name")).alias("n")).collect()[0]
    assert got["p"] == "A&B <x>" and got["id"] == "1" and got["n"] == ""
