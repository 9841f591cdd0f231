"""Fixed values of the data model: levels, relation labels, thresholds, and the schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Levels of a component and their ranks.
RANK = {"PhuLuc": 0, "Phan": 0, "Chuong": 1, "Muc": 2, "TieuMuc": 3, "Dieu": 4, "Khoan": 5, "Diem": 6}
GROUP_LEVELS = ("Phan", "Chuong", "Muc", "TieuMuc")
ALPHABET = "abcdđeghiklmnoprstu"

# Relation labels as written in the source: label, type, whether it runs from the other document to this one.
LABELS = (
    ("Văn bản căn cứ", "CITES", False),
    ("Văn bản dẫn chiếu", "REFERS_TO", False),
    ("Văn bản hết hiệu lực", "TERMINATES", False),
    ("Văn bản HD, QĐ chi tiết", "IMPLEMENTS", False),
    ("Văn bản bổ sung", "SUPPLEMENTS", False),
    ("Văn bản sửa đổi", "AMENDS", False),
    ("Văn bản quy định hết hiệu lực 1 phần", "PARTIALLY_TERMINATES", False),
    ("Văn bản liên quan khác", "RELATED_TO", False),
    ("Văn bản đình chỉ 1 phần", "PARTIALLY_SUSPENDS", False),
    ("Văn bản đình chỉ", "SUSPENDS", False),
    ("Văn bản quy định hết hiệu lực", "TERMINATES", True),
    ("Văn bản được HD, QĐ chi tiết", "IMPLEMENTS", True),
    ("Văn bản bị hết hiệu lực 1 phần", "PARTIALLY_TERMINATES", True),
    ("Văn bản được sửa đổi", "AMENDS", True),
    ("Văn bản được bổ sung", "SUPPLEMENTS", True),
    ("Văn bản bị đình chỉ 1 phần", "PARTIALLY_SUSPENDS", True),
    ("Văn bản bị đình chỉ", "SUSPENDS", True),
)
ELIGIBLE = ("AMENDS", "SUPPLEMENTS", "PARTIALLY_TERMINATES", "PARTIALLY_SUSPENDS")

# Thresholds of the parser, the repairs and the reports.
OUTLIER_JUMP, OUTLIER_RETURN, OUTLIER_LEAST = 20, 5, 3
PARENT_TEXT, SMALL_LEAF, LONG_TEXT, MAD_FACTOR, LABEL_CUT = 100, 10, 3000, 6, 120
MAX_NODES, MAX_EDGES = 200_000, 400_000

_s, _i, _t = T.StringType(), T.IntegerType(), T.TimestampType()


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in cols.items()])


NORM = _schema(norm_id=_s, title=_s, norm_number=_s, norm_type=_s, published_date=_s, valid_from=_s, valid_to=_s, publisher=_s, signer=_s, validity_status=_s, sector=_s, field=_s)
COMPONENT = _schema(comp_id=_s, norm_id=_s, level=_s, rank=_i, citation=_s, order_index=_i, parent_comp_id=_s, title_text=_s)
TEXT_UNIT = _schema(unit_id=_s, accumulated_text=_s, type=_s, language=_s, embedding=T.ArrayType(T.FloatType()), embedded_at=_t, error_log=_s)
ACTION = _schema(action_id=_s, relation_type=_s, amending_doc_number=_s, effective_date=_s, description=_s)
RELATION = _schema(from_norm_id=_s, to_norm_id=_s, relation_type=_s)
ACTION_LINK = _schema(action_id=_s, comp_a_id=_s, comp_b_id=_s, cache_unit_id=_s)
EMBED_ERROR = _schema(unit_id=_s, error=_s, timestamp=_t)
