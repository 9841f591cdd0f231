"""Markup, encodings, look-alikes and languages on awkward texts."""

import html
import html.entities
import unicodedata

import pytest
from pyspark.sql import functions as F

from normspark.llm import encoding as E
from normspark.llm import language as L
from normspark.llm import lookalikes as K
from normspark.llm import markup as M
from normspark.llm.vietnamese import is_syllable

CLEAN = "Cơ quan quản lý nguồn nước được phép hoàn trả chứng từ tại cửa khẩu, trừ trường hợp vi phạm."


@pytest.mark.parametrize("text, want", [
    ("a <b>x</b>", ["html"]), ("a &nbsp; b", ["html"]), ("<!-- x -->", ["html"]), ("## Tiêu đề", ["markdown"]), ("một **hai** ba", ["markdown"]), ("```\nx\n```", ["markdown"]), ("| a | b |\n|---|---|\n| 1 | 2 |", ["markdown"]),
    ("xem [x](/vb/1.htm)", ["markdown"]), ("xem [[a|b]]", ["wiki"]), ("''x''", ["wiki"]), ("=== Mục ===", ["wiki"]), ("{| class=x\n|-\n| 1\n|}", ["wiki"]), ("\\textbf{x}", ["latex"]), ("$P_{1}$", ["latex"]), ("\\item x", ["latex"]),
    ("- Mức 4 # mức 2 (loại A|B).", []), ("Đơn giá 20 $/tấn, phụ phí 7 $/tấn.", []), ("{Mẫu số 1} dùng cho tổ chức & cá nhân.", []), ("Giá trị đo < 7 và > 1 thì đạt.", []), ("(*) Ghi chú: 2 * 1,5.", []),
    ("Người lập biểu: ____________________", []), ("Bảng [STT | Tên gọi]:", []), ("Công thức: T = (a + b) x 2 = c.", []), ("1. Khoản\na) điểm\n- gạch", []), (None, []), ("", []),
])
def test_families(text, want):
    assert M.families(text) == want


def test_stripped_keeps_structure():
    got = M.stripped("## Đầu\nmột **hai** <i>ba</i> &amp; bốn\n* mục\n```\na = 1 * 2\n```\n| x | y |\n|---|---|\n| 1 | 2 |\n[[a|b]] {{c}} \\textbf{d} Công thức: $P_{1}$.")
    assert got == [("heading", "Đầu"), ("text", "một hai ba & bốn"), ("list", "mục"), ("code", "a = 1 * 2"), ("table", "x | y"), ("table", "1 | 2"), ("text", "b d Công thức: ."), ("formula", "P_{1}")]
    assert M.stripped(None) == [] and M.stripped("") == []


def test_style_tree_drops_site_furniture_only(spark):
    pages = [(str(i), f"<html><head><title>t</title></head><body><div class='nav'>Trang chủ</div><h1>Luật {i % 3}</h1><p>Nội dung {i}</p><pre>x = {i}</pre><script>s()</script></body></html>", "h") for i in range(60)]
    pages += [("n", None, "h"), ("e", "", "h"), ("other", "<p>Trang chủ</p>", "few")]
    df = spark.createDataFrame(pages, "key string, text string, host string").withColumn("furniture", F.lit("x"))
    got = {r["key"]: list(zip(r["kinds"], r["texts"])) for r in M.cleaned_pages(df).collect()}
    assert got["7"] == [("heading", "Luật 1"), ("text", "Nội dung 7"), ("code", "x = 7")]
    assert got["n"] == [] and got["e"] == [] and got["other"] == [("text", "Trang chủ")]
    assert M.cleaned_pages(df.filter("false")).count() == 0


def test_nested_furniture_goes_as_a_branch_and_varied_branches_stay(spark):
    menu = "<div class='side'><div class='menu'><ul><li>Trang chủ</li><li>Văn bản</li></ul></div><div class='note'><p>Bản quyền</p></div></div>"
    rows = [(str(i), f"<body>{menu}<div class='main'><h1>Luật</h1>" + f"<p>Đoạn {i}</p>" * (1 + i % 4) + f"<table><tr><th>Mức thu</th></tr><tr><td>ô {i}</td></tr></table>" * (i % 2) + "</div></body>", "h") for i in range(120)]
    df = spark.createDataFrame(rows + [("two", f"<body>{menu}</body>", "small"), ("too", f"<body>{menu}<p>khác</p></body>", "small")], "key string, text string, host string")
    got = {r["key"]: r["texts"] for r in M.cleaned_pages(df).collect()}
    assert got["5"] == ["Đoạn 5", "Đoạn 5", "Mức thu", "ô 5"] and got["4"] == ["Đoạn 4"]  # a title that never changes goes too
    assert got["two"] == ["Trang chủ", "Văn bản", "Bản quyền"] and got["too"][-1] == "khác"  # two pages prove little
    tree = M.merged(df.mapInPandas(M._parse, M._PARSED)).cache()
    e = {(r["host"], r["node"]): r for r in M.branches(tree).collect()}
    low = {k for k, r in e.items() if r["best"] < M.LEAST}
    tops = [r for k, r in e.items() if k in low and (r["host"], r["up"]) not in low]
    assert {r["host"] for r in tops} == {"h"} and any(r["depth"] == 2 and r["m"] == 120 for r in tops)  # the whole side, not its parts
    assert all(e[k]["best"] >= e[k]["own"] for k in e) and max(r["own"] for r in e.values()) <= 1
    assert M.branches(tree.filter("false")).count() == 0


def test_copies_of_a_page_are_not_furniture(spark):
    copy = "<div class='nav'>Trang chủ</div><h1>Luật mẫu</h1><p>Nội dung chung</p>"
    pages = [(f"c{i}", copy, "h") for i in range(900)] + [(str(i), f"<div class='nav'>Trang chủ</div><h1>Luật {i}</h1><p>Nội dung {i}</p>", "h") for i in range(60)]
    df = spark.createDataFrame(pages, "key string, text string, host string")
    got = {r["key"]: r["texts"] for r in M.cleaned_pages(df).collect()}
    assert got["c0"] == got["c899"] == ["Luật mẫu", "Nội dung chung"] and got["7"] == ["Luật 7", "Nội dung 7"]


def test_markup_in_furniture_and_copies_is_found(spark, tmp_path):
    at = "2024-01-01 00:00:00"
    rows = [(i, f"<div class='foot'>Xem **tại đây**</div><p>Nội dung {i}</p>" if i < 60 else "<div class='foot'>Xem **tại đây**</div><p>Theo \\frac{1}{2} và $x^2$</p>", at) for i in range(100)]
    spark.createDataFrame(rows, "id long, content_html string, loaded_at string").withColumn("loaded_at", F.to_timestamp("loaded_at")).write.parquet(f"{tmp_path}/content.parquet")
    spark.createDataFrame([(i, at, "một nguồn") for i in range(100)], "id long, loaded_at string, nguon_thu_thap string").withColumn("loaded_at", F.to_timestamp("loaded_at")).write.parquet(f"{tmp_path}/metadata.parquet")
    spark.createDataFrame([], "unit_id string, accumulated_text string, type string, updated_at timestamp").write.parquet(f"{tmp_path}/text_unit.parquet")
    got = {(r["record_key"], r["family"]) for r in M.residue(spark, str(tmp_path)).collect()}
    assert got == {(str(i), "markdown") for i in range(100)} | {(str(i), "latex") for i in range(60, 100)}


def vni(text: str) -> str:
    """Text as VNI writes it, read as Latin-1: marks as characters of their own, as large as their letter."""
    mark = {unicodedata.normalize("NFC", m): c for c, m in E.VNI_MARKS.items() if c.islower()} | {"\u0306\u0323": "ë"}
    own = {d: c for c, d in E.VNI_LETTERS.items()}
    out = []
    for c in text:
        d = unicodedata.normalize("NFD", c)
        if c in own:
            out.append(own[c])
        elif d[1:2] == "\u031b":
            out.append(own[unicodedata.normalize("NFC", d[:2])] + "".join(m.upper() if d[0].isupper() else m for m in (mark[x] for x in d[2:])))
        else:
            m = "".join(sorted(d[1:], key="\u0302\u0306".find, reverse=True)) if len(d) > 2 else d[1:]
            if m and m not in mark and unicodedata.normalize("NFC", m) not in mark:
                m = m[::-1]
            m = mark[m] if m else ""
            out.append(d[0] + (m.upper() if d[0].isupper() else m))
    return "".join(out)


GARBLED = {
    "cp1252": CLEAN.encode().decode("latin-1"), "mac_roman": CLEAN.encode().decode("mac_roman"), "cp850": CLEAN.encode().decode("cp850"), "twice": CLEAN.encode().decode("latin-1").encode().decode("latin-1"),
    "vni": vni(CLEAN), "vni capitals": vni(CLEAN.upper()),
    "tcvn": "".join({v: chr(k) for k, v in E.TCVN3.items()}.get(c, c) for c in CLEAN),
}


def test_garbled_found_and_restored(spark):
    part = "Tổ chức " + "hoàn trả chứng từ".encode().decode("mac_roman") + " đúng hạn."
    rows = [("text_unit", k, v) for k, v in GARBLED.items()] + [("text_unit", "part", part), ("text_unit", "asked", "C? quan qu?n lý ngu?n n??c ???c phép hoàn tr?"), ("text_unit", "lost", "Tổ ch�c")]
    fine = [CLEAN, "Tên gọi cũ: “Société de l'Île n° 6”, § 2.", "Nhãn hiệu “Grünfeld®” và “Søndal™”, giá 4 €.", "Ống Ø 48 mm ± 2 %, ký hiệu Δt; ©2002.", "theo ГОСТ 2925…", "ĐỢT 2, ÂM LƯỢNG À, Ý KIẾN Ó.", "c­ó B­ình", "hỏi gì? Đáp", None, ""]
    rows += [("content", f"fine{i}", t) for i, t in enumerate(fine)] + [("content", "entity", CLEAN.encode().decode("latin-1").replace("á»", "&aacute;&raquo;"))]
    # pages that spell every character beyond ASCII as an entity, of three kinds
    spelled = {"named": lambda c: f"&{html.entities.codepoint2name[ord(c)]};" if ord(c) in html.entities.codepoint2name else c, "decimal": lambda c: f"&#{ord(c)};", "hex": lambda c: f"&#x{ord(c):X};"}
    pages = {f"{k} {how}": "<p>" + "".join(c if c.isascii() else f(c) for c in GARBLED[k]) + "&amp; x &lt; y</p>" for k in ("cp1252", "tcvn", "vni") for how, f in spelled.items()}
    rows += [("content", k, v) for k, v in pages.items()]
    df = spark.createDataFrame(rows, "source_table string, key string, text string").withColumn("chain", F.lit("x")).withColumn("odds", F.lit(1))
    got = {r["key"]: r for r in E.restored(df).collect()}
    assert set(got) == {*GARBLED, "part", "asked", "lost", "entity", *pages}
    assert {got[k]["original"] for k in pages} == {f"<p>{CLEAN}&amp; x &lt; y</p>"}
    two = df.select("source_table", "key", F.when(F.hash("key") % 2 == 0, "a").otherwise("b").alias("pool"))
    assert {r["key"] for r in E.garbled(df, two).collect()} == set(got)
    for k in GARBLED:
        assert got[k]["original"] == (CLEAN.upper() if "capitals" in k else CLEAN), k
    assert got["part"]["original"] == "Tổ chức hoàn trả chứng từ đúng hạn." and got["asked"]["original"] is None and got["lost"]["original"] is None
    assert E.garbled(df.filter("false")).count() == 0


@pytest.mark.parametrize("w, ok", [("được", True), ("nghiệp", True), ("hîp", False), ("êng", False), ("cap", False), ("cấp", True), ("xyz", False), ("Điều", True)])
def test_syllables(w, ok):
    assert is_syllable(w) is ok


def test_ranges_hold_the_same_letters():
    import re

    from normspark.llm import vietnamese as V

    assert V.ranges("cabxz") == "a-cxz"
    assert set(re.findall(f"[{V.LETTER_CLASS}]", "".join(map(chr, range(0x2FFF))))) == set(V.LETTERS)


def test_one_form_for_what_looks_alike(spark):
    words = {w: 5 for w in "Khoản Điều Chương Phần XVIII quy định tại hướng dẫn khoản I II bình sa".split()}
    root = K.trie(words)
    spell = lambda w: K.spelled(w, root)
    same = ["Khoản 1", "Khoả̉n 1".replace("ả̉", "ả"), "Кхоản 1".replace("х", "h"), "Kh​oản 1", "Ｋｈｏảｎ　１", "Kh­oản 1", "Κhοản 1"]
    assert {K.consistent(t, spell) for t in same} == {"Khoản 1"}
    assert K.consistent("Ðiều 2, Ɖiều 3, Đіều 4", spell) == "Điều 2, Điều 3, Điều 4"
    assert K.consistent("Chương Ⅷ ΧVΙΙΙ các‑bon", spell) == "Chương VIII XVIII các-bon"
    for t in ["m², ½ – ¾ n° “x” Δt α = 0,5 ГОСТ 5", "hoà và hòa", "a  b\n\nc", "Société Søndal ©™", "農業，审查", ""]:
        assert K.consistent(t, spell) == t
    assert K.consistent(unicodedata.normalize("NFD", "chưa hề có từ này"), spell) == "chưa hề có từ này"
    df = spark.createDataFrame([("metadata", str(i), t, 1) for i, t in enumerate(same)] + [("metadata", "null", None, 1), ("metadata", "empty", "", 1)], "source_table string, key string, text string, form int")
    texts = spark.createDataFrame([(" ".join(words),), (None,), ("",)], "text string")
    assert {r["key"] for r in K.changed(df, texts).collect()} == {str(i) for i in range(1, len(same))}
    every = {r["key"]: (r["form"], r["changed"]) for r in K.forms(df, texts).collect()}
    assert {every[str(i)][0] for i in range(len(same))} == {"Khoản 1"}
    assert every["0"] == ("Khoản 1", False) and every["2"] == ("Khoản 1", True) and every["null"] == (None, False) and every["empty"] == ("", False) and len(every) == len(same) + 2
    assert K.changed(df.filter("false"), texts).count() == 0 and K.forms(df, texts.filter("false")).count() == len(every)


def test_letters_that_are_nearly_alike_need_a_word_however_large_the_vocabulary(spark):
    rare = [(f"từ{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8 % 8]}{'qrstuvxy'[i // 64 % 8]}",) for i in range(512)] * 2 + [("hoạch định",)]
    texts = spark.createDataFrame(rare, "text string")
    df = spark.createDataFrame([("component", "known", "kế нoạch"), ("component", "unknown", "kế нxạchz"), ("component", "russian", "нет"), ("component", "spaces", "a\u00a0b"), ("component", "again", "kế нoạch")], "source_table string, key string, text string")
    got = {r["key"]: r["form"] for r in K.forms(df, texts).collect()}
    assert got == {"known": "kế hoạch", "again": "kế hoạch", "unknown": "kế нxạchz", "russian": "нет", "spaces": "a b"}
    assert {r["key"] for r in K.changed(df, texts).collect()} == {"known", "again", "spaces"}


def test_walk_prefers_the_commonest():
    assert K.walk("l​а", K.trie({"la": 2, "là": 9})) == "la" and K.walk("ﬁн", K.trie({"fih": 1, "fi": 9})) == "fih"
    assert K.walk("н", K.trie({"н": 1, "h": 9})) == "н"  # a letter with a weight costs more than the letter itself
    assert K.walk("zzz", K.trie({"la": 1})) is None


SAMPLE = {
    "vi": "Cơ quan đăng ký không được kiểm kê chứng từ đang có tranh chấp khi kết thúc năm tài chính.", "en": "The competent authority shall submit the boundary map within fifteen working days.",
    "de": "Die zuständige Behörde übermittelt den berichtigten Kostenplan binnen fünfzehn Werktagen.", "fr": "Le laboratoire désigné restitue toute pièce relative à l'envoi sans frais supplémentaires.",
    "ru": "Уполномоченный орган может изменить перечень контролируемых товаров при превышении предела.", "zh": "许可证持有人超过规定限额时应当提交检查笔录，并应当提交检查笔录。",
}


@pytest.fixture(scope="module")
def model():
    return L.train(list(SAMPLE.items()) * 2)


def test_labels():
    assert [L.label_of(x) for x in ("Tiếng Việt", "vie", "VI", "fr-FR", "English", "zh_CN", "n/a", "", None, "mul", "??")] == ["vi", "vi", "vi", "fr", "en", "zh", None, None, None, None, None]


def test_languages_and_mixtures(model):
    for lang, t in SAMPLE.items():
        assert L.judged(L.passages((t + " ") * 2, model))[0] == [lang]
    assert L.judged(L.passages(L.plain(SAMPLE["vi"]), model))[0] == ["vi"]
    mixed = SAMPLE["vi"] + " " + SAMPLE["vi"] + "\n" + SAMPLE["en"] + " " + SAMPLE["en"]
    parts = L.passages(mixed, model)
    assert [p[2] for p in parts] == ["vi", "en"] and L.judged(parts)[0] == ["en", "vi"] and mixed[parts[1][0] : parts[1][1]].startswith("The competent")
    assert L.judged(L.passages(SAMPLE["vi"] + " " + SAMPLE["vi"] + " Within fifteen days.", model))[0] == ["vi"]
    assert L.judged(L.passages("123 456 — 7", model)) is None and L.judged(L.passages("", model)) is None


def test_held_out_accuracy(spark):
    import os

    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        pytest.skip("no sample")
    m = L.fitted(spark, d, lambda n: n % 4 != 0)
    rest = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{d}/lang_sample.parquet").collect() if r["sample_no"] % 4 == 0]
    got, _ = m.classify([L._letters(t) for _, t in rest])
    assert sum(a == b for a, (b, _) in zip(got, rest)) / len(rest) >= 0.98
