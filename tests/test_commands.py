"""The stages from the command line, providers, and the match debugger."""

import json
import os

import pytest
from pyspark.sql import functions as F

from normspark.__main__ import main
from normspark.operators import debug, relations
from normspark.sources import files, providers

D = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(D), reason="no test data")
def test_stages(spark, tmp_path, capsys):
    out = str(tmp_path / "out")
    args = ["--input-dir", D, "--output-dir", out]
    assert main(["check", *args], spark) == 0 and main(["check", "--input-dir", str(tmp_path)], spark) == 1
    assert main(["all", *args, "--sample", "20"], spark) == 0
    u = spark.read.parquet(f"{out}/embedded")
    assert (k := u.count()) > 0 and u.filter("embedding is null").count() == 0
    assert main(["embed", *args], spark) == 0 and spark.read.parquet(f"{out}/embedded").count() == k
    n, c = spark.read.parquet(f"{out}/norms"), spark.read.parquet(f"{out}/components")
    assert n.count() == 20 and c.select("comp_id").distinct().count() == c.count()
    assert spark.read.parquet(f"{out}/edge_contains").count() == c.count()
    assert c.filter("parent_comp_id is not null").join(c.select(F.col("comp_id").alias("parent_comp_id")), "parent_comp_id", "left_anti").count() == 0
    assert main(["report", *args], spark) == 0 and "format" in capsys.readouterr().out
    assert main(["estimate", *args], spark) == 0 and main(["estimate", *args, "--max-nodes", "3"], spark) == 1
    (tmp_path / "k").write_text("nghị\n")
    assert main(["keyword", "--input-dir", D, "--output-dir", out, "--keywords-file", str(tmp_path / "k"), "--limit", "3"], spark) == 0
    assert spark.read.parquet(f"{out}/metadata.parquet").count() == 3
    assert main(["sample", *args, "--n", "2"], spark) == 0 and spark.read.json(f"{out}/sample").count() >= 2
    one = "".join(r["value"] for r in spark.read.text(f"{out}/sample_document", wholetext=True).collect())
    assert len(json.loads(one)) == 2
    assert spark.read.json(f"{out}/component_textunit_map").count() > 0 and os.path.exists(f"{out}/action_links")
    assert main(["report", *args, "--sample", "5", "--out", f"{out}/report"], spark) == 0
    r = spark.read.json(f"{out}/report")
    assert r.filter("section = 'format'").agg(F.sum("value")).first()[0] == 5 and r.filter("section = 'fallback'").count() == 1
    assert main(["load", *args, "--max-nodes", "50", "--max-edges", "10"], spark) == 0
    left = sum(spark.read.parquet(f"{out}/load_{n}").count() for n in ("norms", "components", "text_units", "cache_units", "actions"))
    edges = sum(spark.read.parquet(f"{out}/{n}").count() for n in ("edge_contains", "edge_has_textunit", "edge_action", "edge_relation"))
    assert left == 50 and edges == 10
    broken = spark.read.parquet(f"{out}/embedded").limit(3).select("unit_id", F.lit("quota").alias("error"), F.current_timestamp().alias("timestamp"))
    files.write_jsonl(broken, f"{out}/embed_errors")
    assert main(["retry", *args], spark) == 0 and spark.read.parquet(f"{out}/embedded").count() == k and not os.path.exists(f"{out}/embed_errors")
    a, b = (r["norm_id"] for r in n.orderBy("norm_id").limit(2).collect())
    assert main(["explain", *args, "--id-a", a, "--id-b", b], spark) == 0
    assert main(["clean", *args], spark) == 1 and os.path.exists(out) and main(["clean", *args, "--force"], spark) == 0 and not os.path.exists(out)


def test_download(spark, tmp_path):
    src, to = f"{tmp_path}/src", f"{tmp_path}/raw"
    spark.range(3).write.mode("append").parquet(f"{src}/metadata")
    spark.range(2).withColumn("new", F.lit("x")).write.mode("append").parquet(f"{src}/metadata")
    spark.range(5).write.mode("append").parquet(f"{src}/content")
    args = ["--source", src, "--input-dir", to]
    assert main(["download", *args, "--configs", "metadata"], spark) == 0
    assert spark.read.parquet(f"{to}/metadata.parquet").count() == 5 and "new" in spark.read.parquet(f"{to}/metadata.parquet").columns
    spark.range(1).write.mode("append").parquet(f"{src}/metadata")
    main(["download", *args, "--configs", "metadata"], spark)
    assert spark.read.parquet(f"{to}/metadata.parquet").count() == 5  # there already
    main(["extract", *args, "--configs", "metadata"], spark)
    assert spark.read.parquet(f"{to}/metadata.parquet").count() == 6
    assert files.local_table(spark, src, to, "content").count() == 5


def test_json_counts_and_documents(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"type": "a"}\n{"type": "b"}\n{"type": "a", "n": 1}\n{"n": 1}\nnot json\n\n[1]\n')
    got = {r["kind"]: r["rows"] for r in files.jsonl_counts(spark, f"{tmp_path}/x.jsonl", "type").collect()}
    assert got == {"a": 2, "b": 1, "none": 1, "malformed": 2} and files.jsonl_counts(spark, f"{tmp_path}/no", "type").count() == 0
    files.write_keyed(spark.createDataFrame([(7, 'a "b"', None), (None, "x", 1)], "id int, t string, n int"), "id", f"{tmp_path}/doc")
    assert json.loads("".join(r["value"] for r in spark.read.text(f"{tmp_path}/doc", wholetext=True).collect())) == {"7": {"t": 'a "b"', "n": None}}


def test_pacing_and_patience():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    p = providers.Paced(lambda x: x, 60, lambda: now[0], sleep)
    assert [p(i) for i in range(3)] == [0, 1, 2] and slept == [1.0, 1.0]
    left, waits = [2], []

    def flaky():
        left[0] -= 1
        if left[0] >= 0:
            raise RuntimeError("429 Too Many")
        return "ok"

    assert providers.Patient(flaky, sleep=waits.append)() == "ok" and waits == [60, 120]
    with pytest.raises(ValueError):
        providers.Patient(lambda: (_ for _ in ()).throw(ValueError("x")), sleep=waits.append)()


def test_debugger_and_model(spark):
    u = spark.createDataFrame([("a", "a1", "a1__tu", "Bãi bỏ Khoản 3 Điều 9."), ("a", "a2", "a2__tu", "thay thế quy định ở Điều 4"), ("a", "a3", "a3__tu", "không")], "norm_id string, comp_id string, unit_id string, accumulated_text string")
    i = spark.createDataFrame([("b", "Khoản 1 > Điều 9", "b1"), ("b", "Điều 9", "b2"), ("b", "Điều 4", "b4")], "norm_id string, citation_path string, comp_id string")
    got = {r["comp_id"]: r for r in debug.explained(u, i, "a", "b").collect()}
    assert got["a1"]["comp_b_id"] is None and list(got["a1"]["candidates"]) == ["Khoản 1 > Điều 9", "Điều 9"] and got["a2"]["may_amend"] and not got["a3"]["may_amend"]
    m = relations.citations_by_model(u, lambda t: 'CITATION: "Điều 4"').collect()
    assert [(r["comp_id"], r["citation_path"]) for r in m] == [("a2", "Điều 4")]
    assert relations.citations_by_model(u, lambda t: 1 / 0).count() == 0
