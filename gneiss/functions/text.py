"""String, url and date expressions.  Every function takes columns (or names) and returns a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, form names and month names of the sources that are read.
CENTRAL_GROUPS = ("pusat", "central", "peraturan perundang-undangan pusat", "1")
INSTITUTION_GROUPS = ("lembaga", "kementerian/lembaga", "kementerian", "2")
REGIONAL_GROUPS = ("regional", "provinsi", "kabupaten")
CENTRAL_LOCATIONS = ("pemerintah pusat", "indonesia", "republik indonesia")
REGIONAL_FORMS = ("peraturan daerah", "peraturan bupati", "peraturan walikota", "peraturan gubernur")
REGIONAL_TYPE = r"(?i)^(?:peraturan|keputusan|instruksi)\s+(?:daerah|bupati|wali\s*kota)\b"
MONTHS = ("januari", "februari", "maret", "april", "mei", "juni", "juli", "agustus", "september", "oktober", "november", "desember")
#: MIME type -> file extension.
EXTENSIONS = {"application/pdf": ".pdf", "text/html": ".html", "application/json": ".json", "text/plain": ".txt"}

MIB = 1024 * 1024


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(x: Column | str) -> Column:
    """Runs of white space become one space; none at the ends.  Null stays null."""
    return F.trim(F.regexp_replace(_c(x), r"(?U)\s+", " "))


def token(x: Column | str) -> Column:
    """An identifier part: upper case, other characters than A-Z and 0-9 as one underscore, UNKNOWN if empty."""
    bare = F.btrim(F.regexp_replace(F.upper(F.trim(_c(x))), "[^A-Z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit("UNKNOWN"))


def folded(x: Column | str) -> Column:
    """Lower case with the sharp s written out: case folding for the letters that the sources use."""
    return F.replace(F.lower(_c(x)), F.lit("ß"), F.lit("ss"))


def instrument_id(jurisdiction, document_type, year, number, issuer=None) -> Column:
    """JURISDICTION:TYPE:YEAR:NUMBER, and ISSUER with the hash of the folded name where an issuer is given."""
    parts = [token(jurisdiction), token(document_type), token(_c(year).cast("string")), token(number)]
    base = F.concat_ws(":", *parts)
    if issuer is None:
        return base
    name = clean(issuer)
    suffix = F.concat_ws(":", F.lit("ISSUER"), F.sha2(folded(name), 256))
    return F.when(F.coalesce(F.length(name), F.lit(0)) > 0, F.concat_ws(":", base, suffix)).otherwise(base)


def detail_id(url: Column | str) -> Column:
    """The number behind /Details/, else the whole url."""
    found = F.regexp_extract(_c(url), r"(?i)/Details/(\d+)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), _c(url))


def with_params(url: Column | str, params: dict[str, object]) -> Column:
    """The url with query parameters set: known ones in place, new ones behind; empty ones are left out."""
    u = _c(url)
    bare, fragment = F.substring_index(u, "#", 1), F.regexp_extract(u, "#(.*)$", 1)
    path, query = F.substring_index(bare, "?", 1), F.regexp_extract(bare, r"\?(.*)$", 1)
    wanted = {k: str(v) for k, v in params.items() if v is not None and v != ""}
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    names = F.transform(pairs, lambda p: F.try_url_decode(F.substring_index(p, "=", 1)))
    if wanted:
        table = F.create_map(*[x for k, v in wanted.items() for x in (F.lit(k), F.lit(v))])
        kept = F.transform(pairs, lambda p: _set_pair(p, table))
        fresh = F.filter(F.array(*[F.lit(k) for k in wanted]), lambda k: ~F.array_contains(names, k))
        pairs = F.concat(kept, F.transform(fresh, lambda k: F.concat(F.url_encode(k), F.lit("="), F.url_encode(table[k]))))
    joined = F.array_join(pairs, "&")
    return F.concat(path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))


def _set_pair(pair: Column, table: Column) -> Column:
    name = F.try_url_decode(F.substring_index(pair, "=", 1))
    value = F.try_element_at(table, name)
    own = F.when(F.contains(pair, F.lit("=")), pair).otherwise(F.concat(pair, F.lit("=")))
    return F.when(value.isNotNull(), F.concat(F.url_encode(name), F.lit("="), F.url_encode(value))).otherwise(own)


def host(url: Column | str) -> Column:
    """The lower-cased host of a url, null where there is none."""
    return F.lower(F.try_parse_url(_c(url), F.lit("HOST")))


def url_path(url: Column | str) -> Column:
    """The path of a url."""
    return F.try_parse_url(_c(url), F.lit("PATH"))


def query_value(url: Column | str, name: str) -> Column:
    """One query parameter of a url, null where it isn't given."""
    return F.try_parse_url(_c(url), F.lit("QUERY"), F.lit(name))


def absolute(href: Column | str, base: Column | str) -> Column:
    """A link resolved against its page: absolute, //host, /path, ?query, #part and relative forms."""
    h, b = _c(href), _c(base)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(b, r"^([^?#]*)", 1)
    folder = F.when(F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)?", 1) == "", F.concat(root, F.lit("/"))).otherwise(F.regexp_extract(page, r"^(.*/)", 1))
    return (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(root, h))
        .when(h.startswith("?"), F.concat(page, h))
        .when(h.startswith("#"), F.concat(F.regexp_extract(b, r"^([^#]*)", 1), h))
        .when(h == "", b)
        .otherwise(F.concat(folder, F.regexp_replace(h, r"^(\./)+", "")))
    )


def same_host(url: Column | str, base: Column | str) -> Column:
    """Whether a resolved url stays on the host of its page."""
    return F.coalesce(host(url) == host(base), F.lit(False))


def whole_number(x: Column | str) -> Column:
    """A number written with thousands separators."""
    return F.try_to_number(F.nullif(F.regexp_replace(_c(x), r"[^0-9]", ""), F.lit("")), F.lit("9" * 18)).cast("bigint")


#: Wordings of a page's total, the first that matches counts.
TOTALS = (r"menemukan\s+([\d.,]+)\s+peraturan", r"([\d.,]+)\s+peraturan\s+ditemukan", r"([\d.,]+)\s+peraturan\b")


def reported_total(x: Column | str) -> Column:
    """The number of results that a page states, by the first of three wordings that matches."""
    text = clean(x)
    return F.coalesce(*[whole_number(F.nullif(F.regexp_extract(text, f"(?i){p}", 1), F.lit(""))) for p in TOTALS])


def classification(group: Column | str) -> Column:
    """pusat, lembaga, daerah or unresolved for a group's name or number."""
    g = F.lower(clean(F.coalesce(_c(group), F.lit(""))))
    return F.when(g.isin(*CENTRAL_GROUPS), "pusat").when(g.isin(*INSTITUTION_GROUPS), "lembaga").when(g.contains("daerah") | g.isin(*REGIONAL_GROUPS), "daerah").otherwise("unresolved")


def type_classification(group: Column | str, name: Column | str) -> Column:
    """The group's class, but daerah where the type's name is a regional form."""
    return F.when(_c(name).rlike(REGIONAL_TYPE), "daerah").otherwise(classification(group))


def jurisdiction(location: Column | str) -> Column:
    """ID for central and empty locations, else ID/TOKEN."""
    place = clean(F.coalesce(_c(location), F.lit("")))
    name = F.btrim(F.regexp_replace(F.upper(place), "[^A-Z0-9]+", "_"), F.lit("_"))
    return F.when(F.lower(place).isin(*CENTRAL_LOCATIONS) | (name == ""), "ID").otherwise(F.concat(F.lit("ID/"), name))


def font_name(x: Column | str) -> Column:
    """name and subset tag of a font's base name (/ABCDEF+Name)."""
    bare = F.nullif(F.trim(F.regexp_replace(_c(x), "^/+", "")), F.lit(""))
    tag = F.nullif(F.regexp_extract(bare, r"^([A-Z]{6})\+(.*)$", 1), F.lit(""))
    name = F.when(tag.isNull(), bare).otherwise(F.regexp_extract(bare, r"^([A-Z]{6})\+(.*)$", 2))
    return F.struct(name.alias("name"), tag.alias("subset"))


def layout_fingerprint(x: Column | str) -> Column:
    """SHA-256 of the first 64 lines' shapes: digits as #, spaces joined, 80 characters each; null for empty text."""
    t = _c(x)
    lines = F.slice(F.filter(F.split(t, r"\R"), lambda line: F.trim(F.regexp_replace(line, r"\s+", " ")) != ""), 1, 64)
    shapes = F.transform(lines, lambda line: F.substring(F.regexp_replace(F.trim(F.regexp_replace(line, r"\s+", " ")), "[0-9]+", "#"), 1, 80))
    return F.when(F.length(t) > 0, F.sha2(F.array_join(shapes, "|"), 256))


def ink(x: Column | str) -> Column:
    """Characters that aren't white space."""
    return F.length(F.regexp_replace(_c(x), r"(?U)\s", ""))


def content_tags(text: Column | str, coverage: Column | str, chars: Column | str | None = None) -> Column:
    """What a page seems to hold, from its text and the share that images cover; tags in a fixed order."""
    t, cover = _c(text), _c(coverage)
    n = ink(t) if chars is None else _c(chars)
    # fixed values: names of tags and the words that call for them
    table = t.rlike(r"(?i)\b(tabel|tarif|kolom|lokasi|jumlah|satuan)\b")
    found = [
        ("raster_selectable_text", (cover >= 0.70) & (n >= 20)),
        ("article", t.rlike(r"(?i)\bPasal\s+[0-9]+")),
        ("paragraph_number", t.rlike(r"\([0-9]+\)")),
        ("numbers", t.rlike("[0-9]")),
        ("diagram_candidate", t.rlike(r"(?i)\b(bagan|struktur organisasi)\b")),
        ("table_candidate", table),
        ("numeric_table_candidate", table & (F.regexp_count(t, F.lit("[0-9]+")) >= 50)),
        ("little_extracted_text", (n < 20) & (cover > 0.05)),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in found]))


def human_bytes(x: Column | str, largest: str = "TiB") -> Column:
    """1.50 MiB and the like, from B to the largest unit (TiB at most)."""
    n = _c(x).cast("double")
    out = F.format_string("%.2f B", F.bround(n, 2))
    units = ("KiB", "MiB", "GiB", "TiB")
    for k, unit in enumerate(units[: units.index(largest) + 1], 1):
        out = F.when(F.abs(n) >= 1024.0**k, F.format_string(f"%.2f {unit}", F.bround(n / 1024.0**k, 2))).otherwise(out)
    return out


def mime(content: Column | str, declared: Column | str | None = None) -> Column:
    """The MIME type by signature (binary content), then by the declared type without its parameters."""
    c = _c(content)
    head = F.lower(F.decode(F.ltrim(F.regexp_replace(F.decode(F.substring(c, 1, 1024), "ISO-8859-1"), r"^[\x00-\x20]+", "")).cast("binary"), "UTF-8"))
    said = F.lit(None).cast("string") if declared is None else F.nullif(F.lower(F.trim(F.substring_index(_c(declared), ";", 1))), F.lit(""))
    return (
        F.when(F.startswith(c, F.lit(b"%PDF-")), "application/pdf")
        .when(head.startswith("<!doctype html") | head.startswith("<html") | F.contains(head, F.lit("<html")), "text/html")
        .when(head.startswith("{") | head.startswith("["), "application/json")
        .when(said.isNotNull() & (said != "application/octet-stream"), said)
        .otherwise("application/octet-stream")
    )


def extension(mime_type: Column | str) -> Column:
    """The file extension of a MIME type, .bin if unknown."""
    out = F.lit(".bin")
    for kind, ext in EXTENSIONS.items():
        out = F.when(_c(mime_type) == kind, ext).otherwise(out)
    return out


def object_path(sha: Column | str, mime_type: Column | str, compressed: Column | None = None, root: str = "objects") -> Column:
    """root/ab/abcd....ext, with .gz for compressed objects."""
    parts = [F.lit(root + "/"), F.substring(_c(sha), 1, 2), F.lit("/"), _c(sha), extension(mime_type)]
    if compressed is not None:
        parts.append(F.when(compressed, ".gz").otherwise(""))
    return F.concat(*parts)


def pdf_names(x: Column | str) -> Column:
    """/Name tokens of a dictionary."""
    return F.regexp_extract_all(_c(x), F.lit(r"/([A-Za-z0-9_.+-]+)"), F.lit(1))


def pdf_references(x: Column | str) -> Column:
    """Object numbers of the indirect references in a dictionary."""
    return F.transform(F.regexp_extract_all(_c(x), F.lit(r"([0-9]+)\s+[0-9]+\s+R\b"), F.lit(1)), lambda n: n.cast("int"))


def pdf_version(x: Column | str) -> Column:
    """The version in a %PDF- header."""
    return F.nullif(F.regexp_extract(_c(x), r"%PDF-([0-9]+\.[0-9]+)", 1), F.lit(""))


def year(x: Column | str) -> Column:
    """The first year from 1800 to 2099 in a text."""
    return F.nullif(F.regexp_extract(_c(x), r"\b((?:18|19|20)[0-9]{2})\b", 1), F.lit("")).cast("int")


def parse_date(x: Column | str) -> Column:
    """ISO date of '5 Januari 2024' and the like; other texts as they are, cleaned."""
    text = clean(x)
    found = F.lower(text)
    month = F.regexp_extract(found, r"^[0-9]{1,2} ([a-z]+) [0-9]{4}$", 1)
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), month)
    english = F.array_position(F.array(*[F.lit(m) for m in ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")]), month)
    number = F.greatest(number, english)
    iso = F.concat_ws("-", F.regexp_extract(found, "([0-9]{4})$", 1), F.lpad(number.cast("string"), 2, "0"), F.lpad(F.regexp_extract(found, "^([0-9]{1,2})", 1), 2, "0"))
    return F.when(text == "", None).otherwise(F.coalesce(F.when(number > 0, F.try_to_date(iso, "yyyy-MM-dd").cast("string")), text))


def backoff_seconds(attempt: Column | str, most: float = 20.0) -> Column:
    """Doubling waits up to a limit (without the random part)."""
    return F.least(F.pow(F.lit(2.0), _c(attempt).cast("double")), F.lit(most))
