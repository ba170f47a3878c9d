"""PDF files made by hand, read into tables."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gneiss.sources import pdf_files, pdf_objects


def stream(head: str, data: bytes, flate: bool = True) -> bytes:
    data = zlib.compress(data) if flate else data
    filters = "/Filter /FlateDecode" if flate else ""
    return f"<< {head} {filters} /Length {len(data)} >>\nstream\n".encode() + data + b"\nendstream"


def file(objects: dict[int, bytes], trailer: str = "/Root 1 0 R", packed: tuple[int, ...] = ()) -> bytes:
    """A file of the objects; those in ``packed`` go into an object stream."""
    out = b"%PDF-1.6\n%\xe2\xe3\n"
    for n, body in objects.items():
        if n not in packed:
            out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    if packed:
        at, heads = 0, []
        for n in packed:
            heads.append(f"{n} {at}")
            at += len(objects[n]) + 1
        top = (" ".join(heads) + " ").encode()
        out += b"900 0 obj\n" + stream(f"/Type /ObjStm /N {len(packed)} /First {len(top)}", top + b" ".join(objects[n] for n in packed)) + b"\nendobj\n"
        return out + b"901 0 obj\n" + stream(f"/Type /XRef {trailer}", b"") + b"\nendobj\nstartxref\n0\n%%EOF"
    return out + f"trailer\n<< {trailer} >>\nstartxref\n0\n%%EOF".encode()


CMAP = b"1 beginbfchar <01> <00E9> endbfchar 2 beginbfrange <02> <04> <0061> <05> <06> [<007A> <00660069>] endbfrange"
PIXELS = bytes(range(200))
OBJECTS = {
    1: b"<< /Type /Catalog /Pages 2 0 R >>",
    2: b"<< /Type /Pages /Kids [3 0 R 4 0 R 2 0 R] /Count 2 /MediaBox [0 0 200 100] /Resources 5 0 R >>",
    3: b"<< /Type /Page /Parent 2 0 R /Contents [6 0 R 7 0 R] >>",
    4: b"<< /Type /Page /Parent 2 0 R /Rotate 90 /Contents 8 0 R >>",
    5: b"<< /Font << /F1 9 0 R /F2 10 0 R >> /XObject << /I 11 0 R /X 12 0 R >> >>",
    6: stream("", b"BT /F1 12 Tf 10 10 Td (Plain \\(text\\) \\101) Tj ET BT ( ) Tj ET"),
    7: stream("", b"BT /F2 9 Tf [<0102> -300 <030405> 5 <06>] TJ T* (x) ' ET", flate=False),
    8: stream("", b"q 100 0 0 100 0 0 cm /I Do Q q 1 0 0 1 50 0 cm /X Do Q"),
    9: b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>",
    10: b"<< /Type /Font /Subtype /TrueType /BaseFont /ABCDEF+Own#20Font /ToUnicode 13 0 R /FontDescriptor 14 0 R >>",
    11: stream("/Type /XObject /Subtype /Image /Width 20 /Height 10 /BitsPerComponent 8 /ColorSpace [/ICCBased 99 0 R]", PIXELS),
    12: stream("/Type /XObject /Subtype /Form /BBox [0 0 100 100] /Matrix [100 0 0 100 0 0]", b"/I Do /X Do"),
    13: stream("", CMAP),
    14: b"<< /Type /FontDescriptor /FontFile2 15 0 R >>",
    15: stream("", b"a program"),
}


@pytest.mark.parametrize("packed", [(), (1, 2, 3, 4, 5, 9, 10, 14)])
def test_profile(packed):
    got = pdf_objects.profile(file(OBJECTS, packed=packed))
    first, second = got["pages"]
    assert (got["pdf_version"], got["page_count"], got["warnings"]) == ("1.6", 2, [])
    assert [x for x in first["text"].split("\n") if x.strip()] == ["Plain (text) A", "éa bczfi", "x"]
    assert (first["text_blocks"], first["rotation"], first["width"], first["height"], first["font_count"]) == (2, 0, 200, 100, 2)
    assert (second["rotation"], second["width"], second["height"], second["text"]) == (90, 100, 200, "")
    # an image over the left half, and a form that draws it from the place 50 on; turned, x is the old y
    assert [tuple(r.values()) for r in second["rects"]] == [(0, 0, 100, 100), (0, 50, 100, 150)]
    assert second["images"] == [{"xref": 11, "width": 20, "height": 10, "bpc": 8, "colorspace": "ICCBased", "filtercodec": "FlateDecode"}]
    assert (got["programs"], got["contents"]) == ([15], [6, 7, 8])
    own = {o["xref"]: o for o in got["objects"]}
    assert own[11]["sha256"] == hashlib.sha256(zlib.compress(PIXELS)).hexdigest() and own[11]["filters"] == ["FlateDecode"]
    assert own[3]["sha256"] is None and own[3]["encoded_bytes"] == 0


def test_updates_and_damage():
    changed = file(OBJECTS) + b"\n6 0 obj\n" + stream("", b"BT /F1 1 Tf (new) Tj ET") + b"\nendobj\ntrailer\n<< /Root 1 0 R /Prev 9 >>\n%%EOF"
    got = pdf_objects.profile(changed)
    assert got["incremental_updates"] == 1 and got["pages"][0]["text"].startswith("new")
    # a wrong length, a length of its own, and a filter that isn't known
    wrong = OBJECTS | {6: b"<< /Length 3 >>\nstream\nBT /F1 1 Tf (whole) Tj ET\nendstream", 7: b"<< /Length 20 0 R /Filter /LZWDecode >>\nstream\nabc\nendstream", 20: b"3"}
    got = pdf_objects.profile(file(wrong))
    assert got["pages"][0]["text"].startswith("whole") and got["warnings"] == ["content: LZWDecode is not read"]
    assert next(o["encoded_bytes"] for o in got["objects"] if o["xref"] == 7) == 3
    for bad in (b"", b"nothing", b"%PDF-1.4 and no object", file(OBJECTS, "/Root 1 0 R /Encrypt 30 0 R"), file({1: OBJECTS[1]})):
        with pytest.raises(pdf_objects.Unreadable):
            pdf_objects.profile(bad)
    whole = file(OBJECTS)
    for cut in range(0, len(whole), 37):  # cut off anywhere: facts or Unreadable
        try:
            pdf_objects.profile(whole[:cut])
        except pdf_objects.Unreadable:
            pass


def test_tables(spark):
    good = file(OBJECTS)
    files = spark.createDataFrame([("a", bytearray(good)), ("b", bytearray(b"no")), ("c", None)], "sha256 string, content binary")
    scanned = pdf_files.scan(files)
    assert {r.sha256: r.status for r in scanned.collect()} == {"a": "ok", "b": "failed", "c": "failed"}
    got = pdf_files.tables(scanned, files)
    pages = got["pages"].orderBy("page_number").collect()
    assert [(p.class_name, p.image_coverage, p.image_count) for p in pages] == [("born", 0.0, 1), ("raster", 0.75, 1)]
    assert pages[0].text_chars == len("Plain(text)A") + len("éabczfi") + 1 and pages[0].text_pattern_fingerprint and not pages[1].text_pattern_fingerprint
    kinds = {r.xref: r.category for r in got["objects"].collect()}
    assert [kinds[n] for n in (3, 6, 9, 11, 15)] == ["other", "content", "font", "image", "font"]
    rows = {r.sha256: r for r in got["files"].collect()}
    a = rows["a"]
    held = sum(r.encoded_bytes for r in got["objects"].collect())
    assert a.residual_file_bytes == len(good) - held and (a.image_bytes, a.image_object_count, a.font_program_count, a.content_stream_count) == (len(zlib.compress(PIXELS)), 1, 1, 3)
    assert rows["b"].error.startswith("Unreadable") and rows["c"].source_bytes == 0
    assert sorted((r.name, r.subset) for r in got["fonts"].collect()) == [("Helvetica", None), ("Own Font", "ABCDEF")]
    empty = pdf_files.tables(pdf_files.scan(files.where(F.lit(False))), files.where(F.lit(False)))
    assert all(df.count() == 0 for df in empty.values())
