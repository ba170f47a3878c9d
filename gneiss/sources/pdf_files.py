"""PDF files as tables of files, pages, objects, images and fonts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.operators import pdf
from gneiss.sources.pdf_objects import profile
from gneiss.sources.workspace import written

_IMAGE = "struct<xref:int,width:int,height:int,bpc:int,colorspace:string,filtercodec:string>"
_PAGE = f"struct<page_number:int,width:double,height:double,rotation:int,text:string,text_blocks:int,images:array<{_IMAGE}>,font_count:int,rects:array<struct<x0:double,y0:double,x1:double,y1:double>>>"
_OBJECT = "struct<xref:int,encoded_bytes:bigint,sha256:string,filters:array<string>,dictionary_sha256:string>"
_FONT = "struct<xref:int,base_font:string,font_type:string>"
FACTS = f"pdf_version string, page_count int, incremental_updates int, warnings array<string>, pages array<{_PAGE}>, objects array<{_OBJECT}>, images array<{_IMAGE}>, fonts array<{_FONT}>, programs array<int>, contents array<int>"


def scan(files: DataFrame) -> DataFrame:
    """A row for each file (sha256, content), with FACTS; a file that can't be read, or is null, is a row with status failed and its error.

    The table is written once: each file is read once, whatever is derived from it.  A row holds the facts of one file.
    """
    sized = files.select("sha256", F.col("content").cast("binary").alias("content"))
    facts = pdf.isolate(sized, lambda r: profile(r["content"] or b""), FACTS, "sha256")
    return written(facts)


def tables(scanned: DataFrame, files: DataFrame) -> dict[str, DataFrame]:
    """files, pages, objects, images and fonts from what ``scan`` gave for ``files`` (sha256, content)."""
    good = scanned.where("status = 'ok'")
    key = F.col("sha256").alias("file_sha256")
    images = good.select(key, F.explode("images").alias("i")).select("file_sha256", "i.*")
    fonts = good.select(key, F.explode("fonts").alias("f")).select("file_sha256", "f.*")
    fonts = fonts.withColumn("__n", T.font_name("base_font")).withColumns({"name": F.col("__n.name"), "subset": F.col("__n.subset")}).drop("__n")
    programs = good.select(key, F.explode("programs").alias("xref"))
    contents = good.select(key, F.explode("contents").alias("xref"))
    objects = good.select(key, F.explode("objects").alias("o")).select("file_sha256", "o.*")
    objects = pdf.categorize(objects, images, fonts.select("file_sha256", "xref").unionByName(programs), contents)
    pages = good.select("sha256", F.explode("pages").alias("p")).select("sha256", "p.*")
    rects = pages.select("sha256", "page_number", "width", "height", F.explode("rects").alias("r")).select("sha256", "page_number", "width", "height", "r.*")
    covered = pdf.coverage(rects, ["sha256", "page_number"])
    pages = pages.drop("rects").join(covered, ["sha256", "page_number"], "left").withColumn("image_coverage", F.coalesce("coverage", F.lit(0.0))).drop("coverage")
    pages = pages.withColumns({"text_chars": T.ink("text"), "text_pattern_fingerprint": T.layout_fingerprint("text"), "image_count": F.size("images")})
    sizes = files.select("sha256", F.coalesce(F.octet_length(F.col("content").cast("binary")), F.lit(0)).cast("bigint").alias("source_bytes"))
    facts = scanned.select("sha256", "status", "error", "pdf_version", "page_count", "incremental_updates", "warnings", F.size("objects").alias("xref_objects"), F.size("images").alias("image_object_count"), F.size("programs").alias("font_program_count"), F.size("contents").alias("content_stream_count"))
    return {
        "files": pdf.summarize_files(facts.join(sizes, "sha256"), objects),
        "pages": pdf.classify_pages(pages),
        "objects": objects,
        "images": images,
        "fonts": fonts,
    }
