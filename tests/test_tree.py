"""Parsing and repairs, against a plain stack written here and against documents of each case."""

import random
import re

import pytest
from pyspark.sql import functions as F

from normspark import schemas as S
from normspark.functions import text as X
from normspark.operators import repair, tree, units

FULL = """Phần thứ I
Chương I
Mục 1
Điều 1. Phạm vi
1. Nghị định này quy định chi tiết
a) Áp dụng với cơ quan
b) Áp dụng với tổ chức
2. Trường hợp khác do Chính phủ quy định
Điều 2. Đối tượng
1. Cơ quan, tổ chức
Chương II
Điều 3. Nội dung
1. Ban hành văn bản"""


def parse(spark, **docs):
    return tree.components(spark.createDataFrame(list(docs.items()), "norm_id string, markdown string"))


def rows(df):
    return {r["comp_id"]: r for r in df.collect()}


def test_levels_parents_titles(spark):
    r = rows(parse(spark, d=FULL))
    assert len(r) == 13
    assert [r[f"d__c{i}"]["parent_comp_id"] for i in range(1, 14)] == [None, "d__c1", "d__c2", "d__c3", "d__c4", "d__c5", "d__c5", "d__c4", "d__c3", "d__c9", "d__c1", "d__c11", "d__c12"]
    assert r["d__c4"]["title_text"] == "Phạm vi" and r["d__c1"]["citation"] == "Phần I" and r["d__c2"]["title_text"] is None
    assert r["d__c8"]["raw_text"] == "Trường hợp khác do Chính phủ quy định\n" and r["d__c4"]["raw_text"] is None
    assert [x["citation"] for x in r["d__c6"]["ancestors"]] == ["Phần I", "Chương I", "Mục 1", "Điều 1", "Khoản 1"]


def test_index_paths_stop_at_the_article(spark):
    c = parse(spark, d=FULL).withColumn("pos", F.col("order_index").cast("long"))
    got = {r["citation_path"]: r["comp_id"] for r in units.component_index(c).collect()}
    assert got["Điểm a > Khoản 1 > Điều 1"] == "d__c6" and got["Khoản 1 > Điều 2"] == "d__c10" and got["Khoản 1 > Điều 1"] == "d__c5"
    assert got["Mục 1 > Chương I > Phần I"] == "d__c3"


def test_parents_equal_a_stack(spark):
    """Random sequences of levels: windows and a stack find the same parents."""
    rng = random.Random(5)
    mark = {"Phan": "Phần {}", "Chuong": "Chương {}", "Muc": "Mục {}", "Dieu": "Điều {}", "Khoan": "{}. x", "Diem": "a) x{}"}
    docs, want = {}, {}
    for d in range(30):
        stack, lines = [], []
        for i in range(1, rng.randint(2, 40)):
            lv = rng.choice(list(mark))
            lines.append(mark[lv].format(min(i, 19)))
            while stack and stack[-1][0] >= S.RANK[lv]:
                stack.pop()
            want[f"n{d}__c{i}"] = f"n{d}__c{stack[-1][1]}" if stack else None
            stack.append((S.RANK[lv], i))
        docs[f"n{d}"] = "\n".join(lines)
    r = rows(parse(spark, **docs))
    assert {k: v["parent_comp_id"] for k, v in r.items()} == want


def test_null_empty_and_unmarked_documents(spark):
    r = rows(parse(spark, a=None, b="", c="  \n ", d="chỉ có chữ\nthôi"))
    assert list(r) == ["d__c1"] and r["d__c1"]["citation"] == "Điều 1" and r["d__c1"]["raw_text"] == "chỉ có chữ\nthôi\n"
    assert parse(spark, x="Điều 1").filter("false").count() == 0


def test_outlier_article_is_body_text(spark):
    r = rows(parse(spark, d="Điều 3. a\nĐiều 4. b\nĐiều 47. c\nĐiều 5. d\nĐiều 6. e"))
    assert [x["citation"] for x in sorted(r.values(), key=lambda x: x["order_index"])] == ["Điều 3", "Điều 4", "Điều 5", "Điều 6"]
    assert r["d__c2"]["raw_text"] == "b\nĐiều 47. c\n"
    assert len(rows(parse(spark, d="Điều 1. a\nĐiều 30. b"))) == 2


def test_no_window_goes_through_a_document_from_every_line(spark):
    """A frame from a line to the document's end is read again for each line: quadratic in long documents."""
    plan = parse(spark, d=FULL)._jdf.queryExecution().optimizedPlan().toString()
    assert "lead(n#" in plan and not re.search(r"specifiedwindowframe\(\w+, (?!unboundedpreceding)[^,]+, unboundedfollowing", plan)
    assert len(re.findall(r"\bWindow \[", plan)) <= 4  # what each holds of a document stays until its task ends
    many = [f"Điều {i}. a\n1. b" for i in range(1, 31)] + ["chữ\n\nĐiều 70. c\nchữ"] + [f"Điều {i}. a" for i in range(31, 34)]
    r = rows(parse(spark, d="\n".join(many)))
    assert len(r) == 63 and r["d__c60"]["raw_text"] == "b\nchữ\nĐiều 70. c\nchữ\n"


def test_preamble_and_long_parent_text_move_to_the_first_leaf(spark):
    long = "x" * 150
    r = rows(parse(spark, d=f"Căn cứ Luật\nĐiều 1. {long}\n1. một\n2. hai"))
    assert r["d__c2"]["raw_text"] == f"Căn cứ Luật\n{long}\nmột\n" and r["d__c3"]["raw_text"] == "hai\n" and r["d__c1"]["raw_text"] is None
    assert rows(parse(spark, d="Điều 1. ngắn\n1. một"))["d__c2"]["raw_text"] == "một\n"


@pytest.mark.parametrize("line, want", [
    ("Mở đầu. Điều 2. Nội dung", ["Mở đầu. ", "Điều 2. Nội dung"]), ("quy định tại Điều 5. Hết", ["quy định tại Điều 5. Hết"]), ("(Điều 5 của Luật", ["(", "Điều 5 của Luật"]),
    ("Điều 2. 1. Thu ngân sách", ["Điều 2.", " 1. Thu ngân sách"]), ("A Tiểu mục 2 b", ["A ", "Tiểu mục 2 b"]), ("   ", []),
])
def test_header_split(spark, line, want):
    assert spark.createDataFrame([(line,)], "line string").select(X.split_at_headers(F.col("line")).alias("x")).first()["x"] == want


def test_duplicates_best_text_wins_and_losers_take_their_descendants(spark):
    c = parse(spark, d="Điều 1. A\n1. ngắn\nĐiều 1. A\n1. dài hơn nhiều\nĐiều 2. nội dung điều hai\nĐiều 2. nội dung điều hai")
    # both articles 1 are parents without text of their own: the earlier one stays; of the equal articles 2 also
    assert sorted(rows(repair.deduplicated(c))) == ["d__c1", "d__c2", "d__c5"]


def test_ghosts_go(spark):
    c = parse(spark, d="Điều 1. Phạm vi\nChương I\nĐiều 44. dài\nĐiều 45. dài\nĐiều 1. Phạm vi\n1. con của bóng ma\nĐiều 2. khác")
    assert sorted(rows(repair.without_ghosts(c))) == ["d__c1", "d__c2", "d__c3", "d__c4", "d__c7"]


def test_small_leaf_gives_its_text_to_its_parent(spark):
    c = parse(spark, d="Điều 1. T\n1. ngắn\n2. đủ dài để ở lại").withColumn("pos", F.col("order_index").cast("long"))
    done, fix = repair.small_leaves_merged(c)
    r = rows(done)
    assert r["d__c1"]["raw_text"] == "ngắn\n" and r["d__c2"]["raw_text"] is None and r["d__c3"]["raw_text"] == "đủ dài để ở lại\n"
    assert fix.collect()[0]["comp_id"] == "d__c2"


def test_swallowed_points_come_back_after_all_others(spark):
    done, said = repair.repaired(parse(spark, d="Điều 1. T\n1. khoản một có nội dung\na) đầu tiên đủ dài\nb. điểm bị nuốt\nc) cuối cùng đủ dài\n2. khoản hai có nội dung"))
    r = rows(done)
    new = r["d__c3__dpb_rec"]
    assert new["citation"] == "Điểm b" and new["parent_comp_id"] == "d__c2" and new["raw_text"] == "b. điểm bị nuốt" and new["pos"] == max(x["pos"] for x in r.values())
    assert r["d__c3"]["raw_text"] == "đầu tiên đủ dài"
    assert ("B4", "fix") in {(x["rule"], x["severity"]) for x in said.collect()}


def test_swallowed_clauses_and_articles(spark):
    c = parse(spark, d="Điều 1. T\n1. khoản một có nội dung\nthêm dòng").withColumn("pos", F.col("order_index").cast("long"))
    c = c.withColumn("raw_text", F.when(F.col("level") == "Khoan", F.lit("một\n2. hai\n3. ba\n")).otherwise(F.col("raw_text")))
    done, _ = repair.clauses_recovered(c, c)
    r = rows(done)
    assert r["d__c2"]["raw_text"] == "một" and r["d__c2__k2_rec"]["raw_text"] == "2. hai" and r["d__c2__k3_rec"]["order_index"] == 4
    a = parse(spark, d="Điều 1. mở đầu\nĐiều 5. kết").withColumn("pos", F.col("order_index").cast("long"))
    a = a.withColumn("raw_text", F.when(F.col("order_index") == 1, F.lit("đầu\nĐiều 3. giữa\nĐiều 9. ngoài\n")).otherwise(F.col("raw_text")))
    done, said = repair.articles_recovered(a)
    r = rows(done)
    assert r["d__c1"]["raw_text"] == "đầu\nĐiều 9. ngoài" and r["d__c1__d3_rec"]["raw_text"] == "Điều 3. giữa" and said.first()["severity"] == "fix"
    none, said = repair.articles_recovered(a.filter("false"))
    assert none.count() == 0 and said.count() == 0


def test_context_line_cuts_long_titles(spark):
    docs = parse(spark, d=f"Điều 1. {'t' * 130}\n1. một hai ba bốn")
    norms = spark.createDataFrame([("d", "Luật")], "norm_id string, title string")
    u = units.text_units(docs, norms).collect()
    assert [x["accumulated_text"].split("]\n")[0] for x in u] == [f"[Luật > Điều 1 {'t' * 120}…"]
