"""Scalar expressions against values that are known."""

from __future__ import annotations

from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.functions import values as V


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_identity(spark):
    row = one(
        spark,
        T.instrument_id(F.lit("ID"), F.lit("uu"), F.lit(2022), F.lit("27")),
        T.instrument_id(F.lit("ID/KOTA_MOJOKERTO"), F.lit("Perwali"), F.lit(2026), F.lit("6")),
        T.token(F.lit("  ")),
        T.jurisdiction(F.lit("Pemerintah  Pusat")),
        T.jurisdiction(F.lit("Kota Bandung")),
    )
    assert row[0] == "ID:UU:2022:27"
    assert row[1] == "ID_KOTA_MOJOKERTO:PERWALI:2026:6"
    assert tuple(row[2:]) == ("UNKNOWN", "ID", "ID/KOTA_BANDUNG")


def test_issuers_differ(spark):
    a, b, c = one(spark, *[T.instrument_id(F.lit("ID"), F.lit("PER"), F.lit(2020), F.lit("1"), F.lit(x)) for x in ("Menteri A", "Menteri B", "menteri  a")])
    assert a != b and a.split(":")[-1] == c.split(":")[-1]


def test_dates(spark):
    row = one(spark, *[T.parse_date(F.lit(x)) for x in ("5 Januari 2024", " 17  Agustus 1945 ", "31 Februari 2020", "not a date", "3 March 2001")])
    assert tuple(row) == ("2024-01-05", "1945-08-17", "31 Februari 2020", "not a date", "2001-03-03")


def test_numbers_and_years(spark):
    row = one(spark, T.whole_number(F.lit("1.927")), T.reported_total(F.lit("Menemukan 12,345 peraturan")), T.year(F.lit("UU no 5 tahun 1998")), T.year(F.lit("x")), T.detail_id(F.lit("/details/42/x")))
    assert tuple(row) == (1927, 12345, 1998, None, "42")


def test_mime(spark):
    cases = [(b"%PDF-1.7", "text/html", "application/pdf"), (b"  <HTML><body>", "application/pdf", "text/html"), (b'{"a":1}', None, "application/json"), (b"abc", "text/plain; charset=x", "text/plain"), (b"abc", "application/octet-stream", "application/octet-stream")]
    for content, said, wanted in cases:
        assert one(spark, T.mime(F.lit(content), F.lit(said)))[0] == wanted


def test_fingerprint(spark):
    row = one(spark, T.layout_fingerprint(F.lit("")), T.layout_fingerprint(F.lit("  \n ")), T.layout_fingerprint(F.lit("Pasal  1\r\nx")), T.layout_fingerprint(F.lit("Pasal 22\nx\n")))
    assert row[0] is None
    assert row[1] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert row[2] != row[1] and row[2] == row[3]  # a run of digits is one #
    assert one(spark, T.layout_fingerprint(F.lit("Pasal 7 \n\n x")))[0] == row[2]


def test_tags(spark):
    text = "Pasal 12 (3) Tarif tabel BAGAN ORGANISASI"
    assert one(spark, T.content_tags(F.lit(text), F.lit(0.95), F.lit(45)))[0] == ["raster_selectable_text", "article", "paragraph_number", "numbers", "diagram_candidate", "table_candidate"]


def test_urls(spark):
    u = "https://h.example/a/b?x=1&p=2#f"
    row = one(spark, T.with_params(F.lit(u), {"p": 3, "new": "a b", "no": ""}), T.absolute(F.lit("../c"), F.lit(u)), T.absolute(F.lit("c.pdf"), F.lit(u)), T.absolute(F.lit("/r"), F.lit(u)), T.absolute(F.lit("//o.example/z"), F.lit(u)), T.same_host(F.lit("https://H.example/q"), F.lit(u)))
    assert row[0] == "https://h.example/a/b?x=1&p=3&new=a+b#f"
    assert tuple(row[2:]) == ("https://h.example/a/c.pdf", "https://h.example/r", "https://o.example/z", True)


def test_page_classes(spark):
    cases = [(0.95, 45, "raster_text"), (0.0, 45, "born"), (0.95, 3, "raster"), (0.09, 30, "mixed"), (0.5, 3, "unknown")]
    for cover, chars, wanted in cases:
        assert one(spark, V.page_class(F.lit(cover), F.lit(chars)))[0] == wanted


def test_values(spark):
    row = one(spark, V.ratio(F.lit(1), F.lit(0)), V.first_middle_last(F.lit(5)), V.filter_chain(F.array().cast("array<string>")), V.last_filter(F.array(F.lit("a"), F.lit("b"))), T.human_bytes(F.lit(1152)), T.human_bytes(F.lit(5 * 1024**3)), T.human_bytes(F.lit(7)))
    assert tuple(row) == (None, [1, 3, 5], "unfiltered", "b", "1.12 KiB", "5.00 GiB", "7.00 B")
    assert one(spark, V.merge_maps(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("a"), F.lit("3"))))[0] == {"a": "3", "b": "2"}
    assert one(spark, V.jaccard(V.chunk_hashes(F.lit(b"")), V.chunk_hashes(F.lit(b""))))[0] == 1.0


def test_scope_fingerprint():
    scope = {"groups": ["b", "a"], "types": [{"type_id": "1", "reported_total": 5}, {"type_id": "2"}], "query": None}
    same = {"types": [{"type_id": "2", "reported_total": 9}, {"type_id": "1"}], "groups": ["a", "b"], "query": None}
    assert V.scope_fingerprint(scope) == V.scope_fingerprint(same)
    assert V.scope_fingerprint(scope) != V.scope_fingerprint(scope | {"query": "x"})


def test_font_names(spark):
    assert tuple(one(spark, T.font_name(F.lit("/ABCDEF+Arial")))[0]) == ("Arial", "ABCDEF")
    assert tuple(one(spark, T.font_name(F.lit("Arial")))[0]) == ("Arial", None)
