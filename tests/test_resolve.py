from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from namefold.config import ResolveConfig
from namefold.operators import names
from namefold.plans import profiles, resolve, run
from namefold.sources import files
from namefold.workspace import Workspace

ROWS = [
    (1, "Mr. John Smith"),
    (2, "john smith 12/01/2023"),
    (3, "JOHN SMTH"),
    (4, None),
    (5, "#12345678"),
    (6, "Aviva Insurance"),
    (7, "Mr. John Smith"),
    (8, "mr. john smith"),
    # With fewer names than this the two spellings of one person fall short of the recall threshold.
    (9, "Irwin Mitchell"),
    (10, "Sarah Connor"),
]


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(ROWS, "tx int, payee string")


def test_resolution(spark, ws, rows):
    result = resolve.resolve(rows, "payee", ws=ws)
    final = {r["tx"]: r for r in result.final.collect()}
    assert result.final.columns == ["tx", "payee", "cleaned_name", "cluster_id", "representative_name"]
    assert len(final) == len(ROWS)
    assert {final[i]["representative_name"] for i in (1, 2, 3, 7, 8)} == {"john smth"}
    assert final[4]["cleaned_name"] is None and final[4]["cluster_id"] is None
    assert final[5]["cleaned_name"] == "" and final[5]["cluster_id"] is None
    mapping = result.mapping.collect()
    assert len(mapping) == len({n for _, n in ROWS if n})  # case-sensitive, one row per original
    assert profiles.mapping_profile(result.mapping).first().asDict() == {
        "entries": 8, "clusters": 4, "representatives": 4
    }
    summary = profiles.run_summary(rows, result.mapping, result.final).first().asDict()
    assert summary == {"input_rows": 10, "mapping_entries": 8, "clusters": 4, "output_rows": 10}


def test_merge_back_is_the_same_on_both_sides_of_the_limit(spark, ws, monkeypatch):
    rows = spark.range(2000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then concat('n', id % 50) end as payee"
    )
    names_ = [("hot",), *((f"n{i}",) for i in range(45))]  # n45..n49 are not in the mapping
    mapping = spark.createDataFrame(names_, "original_name string").selectExpr(
        "original_name",
        "original_name as cleaned_name",
        "cast(length(original_name) as bigint) as cluster_id",
        "upper(original_name) as representative_name",
    )
    small = resolve.merge_back(rows, mapping, "payee")
    monkeypatch.setattr(resolve, "HOT_NAME_SHARE", 20)  # only "hot" is hot
    large = resolve.merge_back(rows, mapping, "payee", 1000, ws)  # room for the hot name only
    none = resolve.merge_back(rows, mapping, "payee", 10, ws)  # not even for that
    assert sorted(map(tuple, none.collect()), key=str) == sorted(map(tuple, small.collect()), key=str)
    assert small.columns == large.columns and small.dtypes == large.dtypes
    want = sorted(map(tuple, small.collect()), key=str)
    assert sorted(map(tuple, large.collect()), key=str) == want
    assert len(want) == 2000
    assert sum(r[2] is None for r in want) > 600

    def plan(df):
        return df._jdf.queryExecution().sparkPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(resolve.merge_back(rows, mapping, "payee")).count("BroadcastHashJoin") == 1
        large_plan = plan(resolve.merge_back(rows, mapping, "payee", 1000, ws))
        assert large_plan.count("BroadcastHashJoin") == 1 and large_plan.count("SortMergeJoin") == 1
        assert large_plan.count("Range (0, 2000") == 1  # the input is scanned once
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_input(spark, ws, rows):
    result = resolve.resolve(rows.limit(0), "payee", ws=ws)
    assert result.mapping.count() == 0 and result.final.count() == 0
    profile = profiles.source_profile(rows.limit(0), "payee").first()
    assert (profile["total_rows"], profile["reduction_pct"]) == (0, None)


def test_profiles(rows):
    assert profiles.source_profile(rows, "payee").first().asDict() == {
        "total_rows": 10, "unique_names": 8, "reduction_pct": 20.0
    }
    profile = profiles.cleaning_profile(names.cleaning_map(rows, "payee")).first().asDict()
    assert profile == {"names": 8, "modified": 4, "unique_cleaned": 6, "modified_pct": 50.0}


def test_csv_nulls_and_types(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('PayeeName,amount\n"Smith, John",1.5\nNA,2\n,3\n"",4\n007,5\nnull,6\n"say ""hi""",7\n')
    df = files.read_csv(spark, str(path), "PayeeName")
    assert dict(df.dtypes)["PayeeName"] == "string" and dict(df.dtypes)["amount"] == "double"
    got = {r["amount"]: r["PayeeName"] for r in df.collect()}
    assert got == {1.5: "Smith, John", 2.0: None, 3.0: None, 4.0: None, 5.0: "007", 6.0: None, 7.0: 'say "hi"'}
    typed = files.read_csv(spark, str(path), "PayeeName", "PayeeName string, amount int")
    assert {r["amount"] for r in typed.collect()} == {None, 2, 3, 4, 5, 6, 7}


def test_csv_line_breaks(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('PayeeName,amount\n"Smith\nJohn",1\n" Ann ",2\n')
    schema = "PayeeName string, amount int"
    got = {r["amount"]: r["PayeeName"] for r in files.read_csv(spark, str(path), "PayeeName", schema).collect()}
    assert got == {1: "Smith\nJohn", 2: " Ann "}
    assert files.read_csv(spark, str(path), "PayeeName", schema, multi_line=False).count() == 3
    mapping = spark.createDataFrame(
        [("a\nb", "", 1, "x"), (' "q", ', "c", None, None), ("", "", None, None)],
        "original_name string, cleaned_name string, cluster_id bigint, representative_name string",
    )
    files.write_mapping_csv(mapping, str(tmp_path / "mapping"))
    back = files.read_mapping_csv(spark, str(tmp_path / "mapping")).collect()
    assert sorted(map(tuple, back), key=str) == sorted(map(tuple, mapping.collect()), key=str)


def test_run_from_source_to_sink(spark, rows, tmp_path):
    files.write_dataset(rows, str(tmp_path / "in.csv"), "csv")
    rows.write.parquet(str(tmp_path / "in"))
    want = None
    for source in ("in.csv", "in"):
        for sink in (f"{tmp_path}/out-{source}", "t_run_" + source.replace(".", "_")):
            written = run.run(spark, str(tmp_path / source), sink, "payee", schema=rows.schema)
            found = sorted(map(tuple, written.final.collect()), key=str)
            assert written.mapping.count() == 8 and found == (want or found)
            want = found


def test_nothing_is_left_after_close(spark, rows, tmp_path):
    with Workspace(spark, str(tmp_path)) as ws:
        with resolve.resolve(rows, "payee", ws=ws) as result:
            assert result.final.count() == len(ROWS)
            tables = [p for p in (tmp_path / ws.path.split("/")[-1]).iterdir() if "namefold-" not in p.name]
            assert len(tables) <= 12  # what the rounds needed in between is gone
        assert not list(tmp_path.iterdir())


def test_own_word_lists(spark):
    df = spark.createDataFrame([("Herr Max GmbH Co KG",)], "payee string")
    cfg = ResolveConfig(honorifics=("herr",), junk_words=("gmbh", "co kg"))
    assert names.cleaning_map(df, "payee", cfg).first()["cleaned_name"] == "max"
    assert names.cleaning_map(df, "payee").first()["cleaned_name"] == "herr max gmbh co kg"


def test_sinks(spark, ws, rows, tmp_path):
    result = resolve.resolve(rows, "payee", ws=ws)
    files.write_mapping_csv(result.mapping, str(tmp_path / "mapping"))
    back = files.read_mapping_csv(spark, str(tmp_path / "mapping"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, result.mapping.collect()), key=str)
    for fmt in ("parquet", "csv"):
        files.write_dataset(result.final, str(tmp_path / fmt), fmt)
    assert files.read_table(spark, str(tmp_path / "parquet")).count() == len(ROWS)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == len(ROWS)
    for _ in range(2):  # writing again replaces
        files.write_tables(result.mapping, result.final, "t_mapping", "t_final", location=str(tmp_path / "tables"))
    assert files.read_table(spark, "t_mapping").count() == 8
    assert files.read_table(spark, "t_final").count() == len(ROWS)


def test_reports(spark):
    mapping = spark.createDataFrame(
        [(f"o{i}", "c", i // 7, f"r{i // 7}") for i in range(20)] + [("x", "", None, None)] * 9,
        "original_name string, cleaned_name string, cluster_id bigint, representative_name string",
    )
    top = resolve.largest_clusters(mapping, clusters=2, samples=3).orderBy("cluster_id", "sample").collect()
    assert [(r["cluster_id"], r["members"], r["sample"]) for r in top] == [
        (0, 7, 1), (0, 7, 2), (0, 7, 3), (1, 7, 1), (1, 7, 2), (1, 7, 3)
    ]
    order = [r["cluster_id"] for r in resolve.browse_mapping(mapping).collect()]
    assert order[9:] == sorted(order[9:])


def test_workspace_cleans_up(spark, tmp_path):
    with Workspace(spark, str(tmp_path)) as ws:
        kept, seen = ws.save(spark.range(5), "five", rows=F.count(F.lit(1)))
        assert seen == {"rows": 5} and kept.count() == 5
        assert list(tmp_path.iterdir())
    assert not list(tmp_path.iterdir())


def test_workspace_refuses_a_local_warehouse_on_a_cluster(spark, monkeypatch):
    from namefold import workspace

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        def __init__(self, warehouse):
            self.conf = Conf({"spark.sql.warehouse.dir": warehouse})

    with pytest.raises(ValueError):
        workspace._session_root(Session("file:/tmp/warehouse"))
    with pytest.raises(ValueError):
        workspace._session_root(Session("/tmp/warehouse"))
    assert workspace._session_root(Session("s3a://bucket/warehouse")) == "s3a://bucket/warehouse/namefold-work"
