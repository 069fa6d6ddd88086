"""Path keys: lexical normal forms under which two spellings of a path are the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Every character that counts as white space.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip_blank(col: Column) -> Column:
    """Without outer white space of any kind (Spark's ``trim`` takes spaces only)."""
    return F.btrim(col, F.lit(BLANKS))


def path_key(col: Column, fold_case: bool = False) -> Column:
    """Normal form of a path; null for null, blank, and paths of nothing but dots and slashes.

    Outer blanks, a leading ``file://`` or ``./``, ``.`` segments, backslashes,
    repeated and trailing slashes make no difference, nor does letter case with
    ``fold_case``. Most paths have none of these and pass with one look."""
    p = F.replace(strip_blank(col), F.lit("\\"), F.lit("/"))
    q = F.regexp_replace(p, r"(?i)^file://", "")
    q = F.regexp_replace(q, r"/{2,}", "/")
    q = F.regexp_replace(q, r"(^|/)(?:\.(?:/|$))+", "$1")
    q = F.regexp_replace(q, r"/+$", "")
    out = F.when(p.rlike(r"//|/\.?$|/\./|^\./|^\.$"), q).otherwise(p)
    if fold_case:
        out = F.lower(out)
    return F.nullif(out, F.lit(""))


def slashes(col: Column) -> Column:
    """Forward slashes and none at the end."""
    return F.regexp_replace(F.translate(col, "\\", "/"), r"/+$", "")


def basename(col: Column) -> Column:
    return F.regexp_extract(slashes(col), r"([^/]*)$", 1)


def resolve(col: Column, root: str) -> Column:
    """Absolute: under ``root`` unless it starts with a slash; ``.`` and ``..`` segments are resolved lexically (links aren't followed)."""
    p = slashes(col)
    whole = F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), p))
    kept = F.filter(F.split(whole, "/"), lambda x: (x != "") & (x != "."))
    up = lambda done, x: F.when(x != "..", F.concat(done, F.array(x))).otherwise(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
    walked = F.when(F.array_contains(kept, ".."), F.aggregate(kept, F.array().cast("array<string>"), up)).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(walked, "/"))


def lookup_keys(col: Column, root: str) -> Column:
    """The spellings by which a path may be looked up: as it is, resolved, and its file name."""
    return F.array_distinct(F.array(slashes(col), resolve(col, root), basename(col)))


def is_under(col: Column, root: str) -> Column:
    r = root.rstrip("/")
    return (slashes(col) == r) | F.startswith(slashes(col), F.lit(r + "/"))


def relative(col: Column, root: str) -> Column:
    """Relative to ``root``; null outside it."""
    r = root.rstrip("/")
    return F.when(is_under(col, root), F.regexp_replace(F.substring(slashes(col), len(r) + 1, 1 << 30), "^/", ""))


def pair_image(root: str, input_path: Column, object_name: Column, light: Column, ext: str = ".jpg") -> Column:
    """``root/input_path/object_light.ext``; an input path that names a file stays that file."""
    p = slashes(input_path)
    whole = F.concat(F.lit(root.rstrip("/") + "/"), p)
    return F.when(F.lower(p).rlike(r"\.(?:jpe?g|png|bmp)$"), whole).otherwise(F.concat(whole, F.lit("/"), object_name, F.lit("_"), light, F.lit(ext)))


def collapse(col: Column, light: str = "SolderLight", ext: str = ".jpg") -> tuple[Column, Column]:
    """Directory and object name of an image path: its name without ``_light.ext``; null name for other files."""
    p = slashes(col)
    folder = F.regexp_replace(p, r"/?[^/]*$", "")
    ending = f"_{light}{ext}"
    return folder, F.when(F.endswith(p, F.lit(ending)), F.substring(basename(col), F.lit(1), F.length(basename(col)) - len(ending)))


def prefixed_once(col: Column, prefix: str) -> Column:
    """With ``prefix`` before it, unless it stands there already."""
    return F.when(F.startswith(col, F.lit(prefix)), col).otherwise(F.concat(F.lit(prefix), col))
