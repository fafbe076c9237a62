"""Scalar functions against tables of (raw, expected)."""

from decimal import Decimal

import pytest

from millrace.functions import text as T


def value(spark, f, raw):
    return spark.createDataFrame([(raw,)], "x string").select(f("x").alias("y")).first()["y"]


CASES = [
    (T.major_name, [("  kỹ thuật  ", "Kỹ Thuật"), ("NGÀNH: CNTT (KTPM)", "Cntt"), ("Chuyên ngành Luật [CLC]", "Luật"), ("1. y khoa", "Y Khoa"), ("2) Dược", "Dược"), ("Khoa học máy tính", "Khoa Học Máy Tính"), ("", ""), (None, "")]),
    (T.combo, [("a00", "A00"), ("X06", "X06"), ("Toán-Lý-Hóa", "A00"), ("Toán Lý Hóa", "A00"), ("Toan Ly Hoa", "A00"), ("Văn-Sử-Địa", "C00"), ("Toán, Văn, Anh", "D01"), ("Toán-Hóa-Sinh", "A08"), ("t-l-h", "A00"), ("v-s-d", "C00"), ("Khối A00 (x)", "A00"), ("unknown", "KHAC"), ("---", "KHAC"), (None, "KHAC")]),
    (T.combos, [("A00, A01, D01", ["A00", "A01", "D01"]), ("A00; A01; A00", ["A00", "A01"]), ("Toán Lý Hóa; ?", ["A00"]), ("", []), (None, [])]),
    (T.code, [("qsb", "QSB"), ("  BKA  ", "BKA"), ("QSB-HCM", "QSB-HCM"), ("QSB_HCM", "QSBHCM"), ("A" * 50, "A" * 20), (None, "")]),
    (T.score, [("25.5", Decimal("25.50")), ("25,5", Decimal("25.50")), ("25.50 điểm", Decimal("25.50")), ("≥ 25.0", Decimal("25.00")), ("~22.5", Decimal("22.50")), ("99.9", Decimal("99.90")), ("---", None), ("N/A", None), ("", None), ("0", None), ("101", None), ("25.5d", Decimal("25.50")), ("nan", None), (None, None)]),
    (T.quota, [("150", 150), ("150 chỉ tiêu", 150), ("~200", 200), ("-10", 10), ("0", None), ("---", None), (None, None)]),
    (T.method, [("thpt", "THPT"), ("Xét học bạ", "hoc_ba"), ("ĐGNL", "DGNL"), ("chứng chỉ IELTS", "SAT"), ("ưu tiên xét tuyển 2", "xet_tuyen_thang"), ("khác", "khac"), ("???", "THPT"), (None, "THPT")]),
    (T.title_method, [("Điểm xét tuyển thẳng", "xet_tuyen_thang"), ("Đánh giá năng lực", "DGNL"), ("Điểm thi 2024", "THPT"), ("", "THPT")]),
    (T.scan_combo, [("Toán Lý Hóa", "A00"), ("khối d07", "D07"), ("Toán - Lý - Hóa", "KHAC")]),
    (lambda c: T.field(c, 50), [(" a  b \n\n c\td ", "a b\ncd"), (None, "")]),
    (T.is_url, [(" https://a.b", True), ("HTTP://a", False), (None, False)]),
    (T.opt_int, [("12.9", 12), ("-3", None), ("x", None), (None, None)]),
    (T.to_int, [(" 2024 ", 2024), ("2024.0", None), (None, None)]),
    (T.seven_digits, [("12345678", "1234567"), ("123", None)]),
    (T.short_name, [("hust", "HUST"), ("đh", "đh")]),
    (T.nfc, [("é", "é")]),
    (lambda c: T.strip_accents(c, True), [("Điện tử", "Dien tu"), ("é", "e")]),
    (T.strip_accents, [("Điện", "Đien")]),
    (T.slug_code, [("truong-dai-hoc-bka", "BKA")]),
    (T.raw_name, [("Ngành: Luật &amp; A (x)", "Luật A"), (None, "")]),
]


@pytest.mark.parametrize("f, raw, want", [(f, r, w) for f, rows in CASES for r, w in rows])
def test_scalar(spark, f, raw, want):
    assert value(spark, f, raw) == want


def test_keys_are_reproducible(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "x string, y string").select(T.key_id("x", "y").alias("k"), T.auto_code("x").alias("c"))
    a, b = df.collect()
    assert a == b and len(a["k"]) == 32 and a["c"].startswith("AUTO-")
