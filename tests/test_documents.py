"""Extraction, relations, tables of pages, vectors, reports, files and streams on small tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from normspark import schemas as S
from normspark.functions import html as H
from normspark.functions import text as X
from normspark.operators import extract, graph, quality, relations, vector
from normspark.sources import files
from normspark.streaming import ingest


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize("text, want", [
    ('Sửa đổi Khoản 2 Điều 5 của Nghị định số 10/2020/NĐ-CP như sau: "Tổ chức".', "Khoản 2 > Điều 5"), ("Bổ sung Điều 7 của Thông tư này như sau", "Điều 7"), ("Bãi bỏ Khoản 3 Điều 9 của Nghị định", "Khoản 3 > Điều 9"),
    ("Bãi bỏ Điều 12 của Quyết định này.", "Điều 12"), ('Thay thế cụm từ "Bộ Tài chính" bằng cụm từ "Bộ Kế hoạch" tại Khoản 1 Điều 4.', "Khoản 1 > Điều 4"), ('Bỏ cụm từ "và Sở Tài chính" tại Điều 6.', "Điều 6"),
    ("sửa đổi điểm a) khoản 4 điều 38", "Điểm a > Khoản 4 > Điều 38"), ("Bỏ cụm từ “x” tại Điều 6", None), ("bầu cử bổ sung", None), ("", None), (None, None),
])
def test_amended_place(spark, text, want):
    assert one(spark, text, X.amended) == want


def test_prefilter_and_model_reply(spark):
    assert one(spark, "bổ sung\nmột đoạn tại Điều 3", X.may_amend) and not one(spark, "bổ sung " + "x" * 301 + " Điều 3", X.may_amend)
    assert one(spark, 'CITATION: "Khoản 1 > Điều 2"', X.model_reply) == "Khoản 1 > Điều 2" and one(spark, "unknown", X.model_reply) is None and one(spark, "gì", X.model_reply) is None


def test_labels(spark):
    assert len(S.LABELS) == 17 and not {a for a, _, b in S.LABELS if b} & {a for a, _, b in S.LABELS if not b}
    rows = [(i, "a", "b", f" {name} ") for i, (name, _, _) in enumerate(S.LABELS)] + [(90, "a", "b", "lạ"), (91, "a", "a", S.LABELS[0][0]), (92, None, "b", S.LABELS[0][0]), (93, "a", "b", None)]
    r = spark.createDataFrame(rows, "row_id long, doc_id string, other_doc_id string, relationship string")
    got = {x["row_id"]: x for x in relations.relations(r).collect()}
    assert set(got) == set(range(17))
    for i, (_, kind, back) in enumerate(S.LABELS):
        assert (got[i]["relation_type"], got[i]["from_norm_id"]) == (kind, "b" if back else "a")
    assert {x["row_id"] for x in relations.rejected(r).collect()} == {90, 93}


def test_actions(spark):
    rel = spark.createDataFrame([(1, "a", "b", "Văn bản sửa đổi"), (2, "a", "zz", "Văn bản sửa đổi"), (3, "a", "b", "Văn bản căn cứ")], "row_id long, doc_id string, other_doc_id string, relationship string")
    units = spark.createDataFrame([("a", "a__c1", "a__c1__tu", "[t]\nBãi bỏ Điều 2."), ("a", "a__c2", "a__c2__tu", "[t]\nBãi bỏ Điều 9.")], "norm_id string, comp_id string, unit_id string, accumulated_text string")
    index = spark.createDataFrame([("b", "Điều 2", "b__c2")], "norm_id string, citation_path string, comp_id string")
    norms = spark.createDataFrame([("a", "")], "norm_id string, norm_number string")
    a = relations.actions(rel, units, index, norms)
    got = a.collect()
    assert [(r["comp_a_id"], r["comp_b_id"], r["amending_doc_number"]) for r in got] == [("a__c1", "b__c2", "a")]
    assert got[0]["action_id"] == relations.actions(rel, units, index, norms).first()["action_id"]
    comp = spark.createDataFrame([("a__c1",), ("b__c2",)], "comp_id string")
    assert {r["kind"] for r in graph.action_edges(a, a, relations.cache_units(a), comp).collect()} == {"HAS_ACTION", "APPLY_TO", "HAS_TEXTUNIT"}
    assert graph.action_edges(a, a, relations.cache_units(a), comp.filter("comp_id <> 'b__c2'")).count() == 0


def test_keyword_extraction(spark):
    m = spark.createDataFrame([(1, "Luật THUẾ"), (2, "Khác"), (3, None), (4, ""), (5, "thuế đất")], "id long, title string")
    c = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, content_html string")
    r = spark.createDataFrame([(1, "1", "2", "r"), (2, "2", "5", "r"), (3, "1", "5", "r"), (4, "2", "3", "r")], "row_id long, doc_id string, other_doc_id string, relationship string")
    t = extract.filtered(m, c, r, ["thuế"])
    assert {x["id"] for x in t["metadata"].collect()} == {1, 5} and t["content"].count() == 1 and {x["row_id"] for x in t["relationships"].collect()} == {1, 2, 3}
    a = {x["row_id"]: (x["owner"], x["direction"]) for x in extract.attached(r, t["metadata"]).collect()}
    assert a == {1: ("1", "outgoing"), 2: ("5", "incoming"), 3: ("1", "outgoing")} and extract.attached(r, t["metadata"], 1).count() == 1
    assert [x["id"] for x in extract.matched(m, ["thuế"], 1).collect()] == [1] and extract.matched(m, ["không có"]).count() == 0
    assert extract.sample(m, c, 3).count() == 3


@pytest.mark.parametrize("page, want", [
    ("<table><tr><td>một</td></tr></table>", "Bảng [một]:"), ("<table><tr><td> </td></tr></table>", ""), ("<table></table>", ""), ("<p>a<br>b</p>c", "a\nb\nc"),
    ("<table><tr><td><table><tr><th>h</th></tr><tr><td>v</td></tr></table></td></tr></table>", "Bảng [h]:\nh: v"), ("<table><tr><td>x</td><td><img src='file:///C:/clip_image001.gif'></td></tr></table>z", "z"),
    ("<table><tr><td colspan=2>a</td></tr><tr><td colspan=2>b</td></tr></table>", "Bảng [a | a]:\na: b, a: b"), ("<table><tr><th>A</th><th>B</th></tr><tr><td></td><td></td></tr><tr><td>1</td><td></td></tr></table>", "Bảng [A | B]:\nA: 1, B: "),
    ("<p>x......... y</p><script>z</script>", "x y"), (None, ""), ("", ""),
])
def test_pages(page, want):
    assert H.convert(page) == want


def test_pipe_tables():
    assert H.tables_to_prose("đầu\n| h | k |\n|---|---|\n| 1 | [2](u) |\ncuối") == "đầu\nBảng [h | k]:\nh: 1, k: 2\ncuối" and H.tables_to_prose("| | |\n|--|--|") == ""


def test_unreadable_pages_say_why(spark, monkeypatch):
    df = H.converted(spark.createDataFrame([(1, "<p>a</p>"), (2, None)], "id int, content_html string"))
    assert {r["id"]: (r["markdown"], r["convert_error"]) for r in df.collect()} == {1: ("a", None), 2: ("", None)}


def test_cosine_and_jobs(spark):
    u = spark.createDataFrame([("a", [1.0, 0.0], "noi_dung", "x"), ("b", [0.0, 2.0], "cache_action", "x"), ("c", [3.0, 0.0], "noi_dung", "x"), ("z", [0.0, 0.0], "noi_dung", "x"), ("n", None, "noi_dung", "chữ"), ("e", None, "noi_dung", " ")], "unit_id string, embedding array<float>, type string, accumulated_text string").withColumn("error_log", F.lit("cũ"))
    assert [r["unit_id"] for r in vector.top_k(u, [1.0, 0.0], 2).collect()] == ["a", "c"]
    assert [r["unit_id"] for r in vector.top_k(u, [0.0, 1.0], 1, then=F.col("type") != "cache_action").collect()] == []
    assert [r["unit_id"] for r in vector.pending(u).collect()] == ["n"] and [r["unit_id"] for r in vector.unembeddable(u).collect()] == ["e"]
    done = {r["unit_id"]: r for r in vector.with_embeddings(u, vector.embedded(vector.pending(u))).collect()}
    assert len(done["n"]["embedding"]) == 64 and done["n"]["error_log"] is None and done["a"]["error_log"] == "cũ"

    def broken(_):
        raise RuntimeError("429 quota")

    assert "quota" in vector.embedded(vector.pending(u), broken).first()["error_log"]
    assert vector.retrieve(u, None, None, None, "?") is None
    again, lost = vector.retried(u, spark.createDataFrame([("a",), ("a",), ("gone",)], "unit_id string"))
    assert again.count() == 1 and lost.first()["unit_id"] == "gone"


def test_report_classes(spark):
    rows = [("1", "[A > B]\nnội dung"), ("2", "[A]\n"), ("3", "không"), ("4", None), ("5", "[A > B]\nBảng [x]:\nx: 1\nBảng []:"), ("6", "[A > B]\n| a |\n|---|\n\x07�")]
    u = spark.createDataFrame(rows, "unit_id string, accumulated_text string")
    got = {(r["section"], r["metric"]): r["value"] for r in quality.report(u).collect()}
    assert got["format", "ok"] == 3 and got["format", "header_no_separator"] == 1 and got["format", "no_header"] == 1 and got["format", "null_text"] == 1
    assert got["flags", "pipe_table"] == 1 and got["flags", "empty_header"] == 1 and got["flags", "control"] == 1 and got["flags", "replacement"] == 1 and got["tables", "2"] == 1 and got["length", "0"] == 1
    assert quality.report(u.filter("false")).count() == 0


def test_checks_of_nothing(spark):
    c = spark.createDataFrame([], "comp_id string, parent_comp_id string, citation string")
    u = spark.createDataFrame([], "unit_id string, type string, accumulated_text string, embedding array<float>")
    assert tuple(quality.leaf_coverage(c, u).first()) == (0, 0, 0.0) and tuple(quality.short_units(u).first()) == (0, 0, 0.0) and tuple(quality.embedded_share(u).first()) == (0, 0, 0.0)
    assert quality.reversed_citations(spark.createDataFrame([("a", "x", "Điều 1 Khoản 2"), ("b", "x", "Khoản 2 Điều 1")], "comp_id string, parent_comp_id string, citation string")).count() == 1


def test_edges_and_budget(spark):
    n = spark.createDataFrame([("n",)], "norm_id string")
    c = spark.createDataFrame([("c1", "n", None), ("c2", "n", "c1"), ("c3", "n", "gone"), ("c4", "other", None)], "comp_id string, norm_id string, parent_comp_id string")
    assert {tuple(r) for r in graph.contains_edges(c, n).collect()} == {("n", "c1"), ("c1", "c2")}
    u = spark.createDataFrame([("c1__tu", "noi_dung"), ("c2__tu__p2", "noi_dung"), ("k", "cache_action"), ("odd", None)], "unit_id string, type string")
    o = spark.createDataFrame([("odd", "c2")], "unit_id string, comp_id string")
    assert {tuple(r) for r in graph.has_textunit_edges(u, o).collect()} == {("c1", "c1__tu"), ("c2", "c2__tu__p2"), ("c2", "odd")}
    t = graph.budgeted({"norm": (n, ["norm_id"]), "component": (c, ["comp_id"])}, 3)
    assert t["norm"].count() == 1 and [r["comp_id"] for r in t["component"].collect()] == ["c1", "c2"]
    assert graph.sizes(1, 2, 3, 4, 5, 6, 7) == {"nodes": 15, "edges": 28}


def test_files(spark, tmp_path):
    p = str(tmp_path)
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(f"{p}/t/one.parquet")
    spark.createDataFrame([(2,)], "a int").write.parquet(f"{p}/u.parquet")
    with pytest.raises(FileNotFoundError, match="metadata"):
        files.load_local(spark, p)
    files.ingest(spark.createDataFrame([(1,)], "a int"), f"{p}/u.parquet")
    assert spark.read.parquet(f"{p}/u.parquet").first()["a"] == 2
    files.ingest(spark.createDataFrame([(3,)], "a int"), f"{p}/u.parquet", force=True)
    assert spark.read.parquet(f"{p}/u.parquet").first()["a"] == 3
    (tmp_path / "k.txt").write_text("# lời\n Thuế \n\n")
    assert files.keywords(spark, f"{p}/k.txt") == ["thuế"]
    (tmp_path / "none.txt").write_text("#\n")
    with pytest.raises(ValueError):
        files.keywords(spark, f"{p}/none.txt")
    assert files.read_jsonl(spark, f"{p}/missing.jsonl", S.RELATION).count() == 0
    files.write_jsonl(spark.createDataFrame([("a", "b", None)], S.RELATION), f"{p}/r.jsonl")
    assert files.read_jsonl(spark, f"{p}/r.jsonl", S.RELATION).first()["to_norm_id"] == "b"
    v = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert files.violations(v, ["k"]).count() == 2 and files.lookup(v, "k", [1]).count() == 2


def test_upsert_and_stream(spark, tmp_path):
    t = lambda h: datetime(2024, 1, 1, h)
    schema = "id long, v string, at timestamp"
    p = str(tmp_path)
    spark.createDataFrame([(1, "old", t(1)), (2, "two", t(1))], schema).coalesce(1).write.parquet(f"{p}/in")
    like = spark.createDataFrame([], schema)
    run = lambda: ingest.merge_into(ingest.arriving(spark, f"{p}/in", like), f"{p}/out", ["id"], "at", f"{p}/check").awaitTermination()
    run()
    assert {tuple(r)[:2] for r in ingest.current(spark, f"{p}/out").collect()} == {(1, "old"), (2, "two")}
    spark.createDataFrame([(1, "new", t(3)), (1, "mid", t(2)), (3, "three", t(1))], schema).coalesce(1).write.mode("append").parquet(f"{p}/in")
    run()
    assert {tuple(r)[:2] for r in ingest.current(spark, f"{p}/out").collect()} == {(1, "new"), (2, "two"), (3, "three")}
    run()
    assert ingest.current(spark, f"{p}/out").count() == 3
    w = ingest.loaded_per_window(like, "at")
    assert w.columns == ["since", "n"] and ingest.current(spark, f"{p}/nowhere") is None


def test_library_stands_without_the_corpus_package():
    import os
    import re

    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "normspark")
    for folder, _, names in os.walk(root):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert not re.search(r"normspark\.llm|from \.+llm", open(os.path.join(folder, n)).read()), n


PAGES = [
    ("<table><tr><th>Tên</th><th>Mức</th></tr><tr><td>a</td><td>1</td></tr><tr><td>b</td><td></td></tr></table>", "Bảng [Tên | Mức]:\nTên: a, Mức: 1\nTên: b, Mức: "),
    ("<table><tr><th colspan='2'>Cha</th><th rowspan='2'>Kia</th></tr><tr><td>x</td><td>y</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>", "Bảng [Cha > x | Cha > y | Kia]:\nCha > x: 1, Cha > y: 2, Kia: 3"),
    ("<p>Một</p><table><tr><td> </td></tr></table><p>Hai.......... ba</p>", "Một\nHai ba"),
    ("<table><tr><td>Tên</td></tr><tr><td rowspan=2>v</td></tr><tr></tr></table>", "Bảng [Tên]:\nTên: v\nTên: v"),
    ("<table><tr><td colspan=2>a</td></tr><tr><td colspan=2>b</td></tr></table>", "Bảng [a | a]:\na: b, a: b"),
    ("<table><tr><td colspan=x>a</td><td rowspan=2>c</td></tr><tr><td>1</td></tr><tr><td>2</td><td>d</td></tr></table>", "Bảng [a | c]:\na: 1, c: c\na: 2, c: d"),
    ("<table><tr><td><table><tr><td>trong</td></tr></table></td></tr></table>", "Bảng [trong]:"),
    ("<table><tr><td><img src='file:///C:/x/clip_image001.png'></td><td>chữ</td></tr></table>sau", "sau"),
    ("", ""),
]


def test_pages_with_tables():
    for page, want in PAGES:
        assert H.convert(page) == want, page


def test_markdown_tables():
    md = "a\n| Tên | [Mức](x) |\n|---|:-:|\n| a<br>b | |\n| - | - |\n\n| |\n|  |\nz"
    assert H.tables_to_prose(md).split("\n") == ["a", "Bảng [Tên | Mức]:", "Tên: a b, Mức: ", "", "z"]
    assert H.tables_to_prose("| ![](file:///C:/clip_image1.png) | chữ |\nsau") == "sau"


def test_lines_split_at_headers(spark):
    lines = {
        "Mở đầu. Điều 2. Nội dung": "Mở đầu. |Điều 2. Nội dung", "quy định tại Điều 5. Hết": "quy định tại Điều 5. Hết", "Điều 2. 1. Thu ngân sách": "Điều 2.| 1. Thu ngân sách", "Điều 1. Phạm vi": "Điều 1. Phạm vi",
        "kín.Điều 3 khác": "kín.|Điều 3 khác", "theo Chương II và Mục 3": "theo Chương II và |Mục 3", "A Phần I B Chương II C": "A |Phần I B |Chương II C", "  ": "",
    }
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert {r["line"]: r["p"] for r in df.select("line", F.array_join(X.split_at_headers(F.col("line")), "|").alias("p")).collect()} == lines
