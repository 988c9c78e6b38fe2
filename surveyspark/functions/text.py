"""String, URL, path and nested-array column helpers (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_text(x: Column, decimals: int = 1) -> Column:
    """``f"{x:.{d}%}"``: ``x*100`` with ``d`` decimals and a percent sign.

    ``bround`` first (half-even on the decimal value) so ties that Python
    resolves to even are not pushed up by Java's formatter.
    """
    return F.format_string(f"%.{decimals}f%%", F.bround(x * 100.0, decimals))


def last_path_segment(path: Column) -> Column:
    """Last non-empty segment of a slash path (a trailing slash is ignored)."""
    return F.regexp_extract(path, r"([^/]+)/?$", 1)


def path_suffix(name: Column) -> Column:
    """Suffix of a file name as ``pathlib`` defines it (``''`` for ``.hidden``)."""
    return F.regexp_extract(name, r".(\.[^.]+)$", 1)


def url_extension(url: Column, default: str = ".jpg") -> Column:
    """Extension of the URL's path component, ``default`` when it has none."""
    ext = path_suffix(last_path_segment(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))))
    return F.when(ext == "", F.lit(default)).otherwise(ext)


def raw_url_extension(url: Column, default: str = ".jpg") -> Column:
    """Suffix of the raw URL text (query and fragment included), as one importer takes it."""
    ext = path_suffix(last_path_segment(url))
    return F.when(ext == "", F.lit(default)).otherwise(ext)


def url_hash_name(url: Column, ext: Column | None = None) -> Column:
    """Content-addressed file name: first 16 hex digits of MD5(url) plus extension."""
    u = F.trim(url)
    return F.concat(F.substring(F.md5(u), 1, 16), ext if ext is not None else url_extension(u))


def species_from_dirname(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(" "))


def species_dirname(species: Column) -> Column:
    return F.replace(species, F.lit(" "), F.lit("_"))


def _without_dots(p: Column) -> Column:
    """``./`` steps dropped, ``x/../`` steps taken back; leading ``..`` stay."""
    def step(done, s):
        back = (s == "..") & (F.size(done) > 0) & ~F.coalesce(F.element_at(done, -1).isin("..", ""), F.lit(False))
        return F.when(s == ".", done).when(back, F.slice(done, 1, F.size(done) - 1)).otherwise(F.concat(done, F.array(s)))

    return F.array_join(F.aggregate(F.split(p, "/"), F.array().cast("array<string>"), step), "/")


def normalize_path(path: Column, root: str | None = None) -> Column:
    """Project-relative POSIX path: backslashes to slashes, ``file:`` scheme, ``.`` and ``..`` steps and a known
    root prefix gone.

    Pure string work; file existence is checked by joining to a file listing.
    """
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    p = F.when(p.startswith("file:/"), F.regexp_replace(p, "^file:/+", "/")).otherwise(p)
    p = F.when(p.contains("./"), _without_dots(p)).otherwise(p)
    if root:
        r = root.replace("\\", "/").rstrip("/") + "/"
        p = F.when(p.startswith(r), p.substr(F.lit(len(r) + 1), F.length(p))).otherwise(p)
    return p


def resolve_path(path: Column, root: str) -> Column:
    """Absolute paths stay; relative ones are placed under ``root``."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    absolute = p.startswith("/") | p.rlike(r"^[A-Za-z]:/")
    return F.when(absolute, p).otherwise(F.concat_ws("/", F.lit(root.rstrip("/")), p))


def first_media_identifier(media: Column, media_type: str = "StillImage") -> Column:
    """Identifier of the first array element of the given type with a non-empty identifier."""
    hits = F.filter(media, lambda m: (m["type"] == media_type) & m["identifier"].isNotNull()
                    & (m["identifier"] != ""))
    return F.get(hits, 0)["identifier"]


def blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t == "", F.lit(None)).otherwise(t)


def region_fallback(*cols: Column, default: str = "Unknown") -> Column:
    """First of the columns that is neither null nor blank, else ``default``."""
    return F.coalesce(*[blank_to_null(c.cast("string")) for c in cols], F.lit(default))


def normalize_id(c: Column) -> Column:
    """Ids that arrive as ``123`` or ``123.0`` (or junk) -> bigint or null."""
    s = F.trim(c.cast("string"))
    return F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"))
