"""Label and identifier text: normal forms, labels in names, and answers read out of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks.functions.paths import strip_blank

# fixed values
SINGLE_ANSWERS = ("OK", "NG")
COMPARISONS = {"<": "<", "lt": "<", "<=": "<=", "lte": "<=", "le": "<=", ">": ">", "gt": ">", ">=": ">=", "gte": ">=", "ge": ">="}


def clean_label(col: Column) -> Column:
    """Without outer white space, upper case: the form in which predictions are judged."""
    return F.upper(strip_blank(col))


def is_defect(label: Column, pass_label: str = "PASS") -> Column:
    return clean_label(label) != F.lit(pass_label.strip().upper())


def training_label(col: Column, pass_label: str = "PASS") -> Column:
    """Exactly ``PASS`` stays; everything else is stripped and lower-cased (unlike :func:`clean_label`, case decides)."""
    return F.when(col == pass_label, col).otherwise(F.lower(strip_blank(col)))


def okng(col: Column) -> Column:
    """``OK`` or ``NG``: the last that stands alone in the text, ``UNKNOWN`` for none (null too)."""
    found = F.try_element_at(F.regexp_extract_all(F.upper(strip_blank(col)), F.lit(r"\b(OK|NG)\b"), F.lit(1)), F.lit(-1))
    return F.coalesce(found, F.lit("UNKNOWN"))


def yesno(col: Column) -> Column:
    """``yes`` or ``no`` if exactly one of them stands in the text, else null."""
    yes, no = (F.coalesce(F.lower(col).rlike(rf"\b{w}\b"), F.lit(False)) for w in ("yes", "no"))
    return F.when(yes & ~no, "yes").when(no & ~yes, "no")


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.translate(path, "\\", "/"), r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def label_in_name(path: Column) -> Column:
    """From ``board+defect_00012.png``: what follows the first ``+`` in the stem, without its last ``_suffix``; null if that is nothing."""
    return F.nullif(F.regexp_replace(F.regexp_extract(file_stem(path), r"^[^+]*\+(.*)$", 1), r"_[^_]*$", ""), F.lit(""))


def defect_type(path: Column) -> Column:
    return F.coalesce(label_in_name(path), F.lit("unknown"))


def anomaly_prefix(path: Column) -> Column:
    """Without directory and ``_<digits>.png`` or ``.jpg``."""
    return F.regexp_replace(F.regexp_extract(F.translate(path, "\\", "/"), r"([^/]*)$", 1), r"_[0-9]+\.(?:png|jpg)$", "")


def first_nonblank(*cols: Column) -> Column:
    """The first of several columns that is neither null nor blank, stripped."""
    return F.coalesce(*(F.nullif(strip_blank(c.cast("string")), F.lit("")) for c in cols))


def slug(col: Column, sep: str = "_") -> Column:
    """Lower case, every run of other characters than a-z and 0-9 as one separator, none outside."""
    return F.regexp_replace(F.regexp_replace(F.lower(col), r"[^a-z0-9]+", sep), f"^{sep}+|{sep}+$", "")


def metric_key(name: Column, unit: Column) -> Column:
    """The slug of a metric's display name: ``far_pct`` for FAR in per cent, ``primary_metric`` for names without letters and digits."""
    key = slug(name)
    return F.when((key == "far") & (unit == "%"), "far_pct").otherwise(F.coalesce(F.nullif(key, F.lit("")), F.lit("primary_metric")))


def platform_slug(col: Column) -> Column:
    """Kebab case: blanks and underscores become single dashes. Null (refused) if another character is left, or more than 32."""
    dashed = F.regexp_replace(F.regexp_replace(F.lower(strip_blank(col)), r"[\s_-]+", "-"), r"^-|-$", "")
    return F.when(dashed.rlike(r"^[a-z0-9][a-z0-9-]{0,31}$"), dashed)


def safe_id(col: Column) -> Column:
    """Only letters, digits, dot, dash and underscore, others as one dash; it starts with a letter or digit, and doesn't end in a dot or dash. ``job`` if nothing is left."""
    dashed = F.regexp_replace(col, r"[^A-Za-z0-9._-]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(dashed, r"^[^A-Za-z0-9]+|[.-]+$", ""), F.lit("")), F.lit("job"))


def gpu_arch(col: Column) -> Column:
    """``sm_90`` from spellings such as ``SM90``, ``compute_90``, ``90`` and ``9.0``; an ``a`` or ``f`` behind it stays. Null for others."""
    text = F.replace(F.replace(F.lower(strip_blank(col)), F.lit("compute_"), F.lit("sm_")), F.lit("-"), F.lit("_"))
    plain = F.regexp_extract(text, r"^(?:sm_?)?(\d{2,3}[af]?)$", 1)
    dotted = F.regexp_replace(F.regexp_extract(text, r"^(\d+\.\d+[af]?)$", 1), r"\.", "")
    number = F.coalesce(F.nullif(plain, F.lit("")), F.nullif(dotted, F.lit("")))
    return F.concat(F.lit("sm_"), number)


def gpu_family(col: Column) -> Column:
    """The architecture without its variant."""
    return F.regexp_replace(gpu_arch(col), "[af]$", "")


def gpu_supported(target: Column, candidates: list[str]) -> Column:
    """Whether any of the candidates is of the target's family; null for a target that is no architecture."""
    return gpu_family(target).isin([gpu_family(F.lit(c)) for c in candidates]) if candidates else F.lit(False)


def redact(col: Column) -> Column:
    """Values behind names of credentials, and bearer tokens, as ``***``."""
    named = F.regexp_replace(col, r"(?i)\b((?:api[_-]?key|token|secret|password|passwd|access[_-]?key)\"?\s*[=:]\s*\"?)[^\s\",;]+", "$1***")
    return F.regexp_replace(named, r"(?i)\b(bearer\s+)[A-Za-z0-9._~+/-]+=*", "$1***")


def compare(value: Column, operator: Column, target: Column) -> Column:
    """``value operator target`` for an operator or its word; null for any other operator."""
    op = F.lower(strip_blank(operator))
    spelled = lambda sign: op.isin([k for k, v in COMPARISONS.items() if v == sign])
    return F.when(spelled("<"), value < target).when(spelled("<="), value <= target).when(spelled(">"), value > target).when(spelled(">="), value >= target)


_NUMBER = r"-?(?:\d+(?:\.\d*)?|\.\d+)"
TARGET = rf"(?i)^\s*(.+?)\s*(<=|>=|<|>)\s*({_NUMBER})\s*(\S*)(?:\s+at\s+(.+?))?\s*$"


def parse_target(col: Column) -> Column:
    """A target such as ``FAR <= 5 % at recall = 100%`` as a struct; null where the text has another form.

    FAR in per cent is evaluated at a recall (``recall_target_pct``, 100 where the context names none); what
    stands behind ``at`` for any other metric is its ``evaluation_context``, and its evaluator is yet to be named."""
    part = lambda i: F.regexp_extract(col, TARGET, i)
    key, context = metric_key(part(1), part(4)), F.nullif(strip_blank(part(5)), F.lit(""))
    far = key == "far_pct"
    recall = F.regexp_extract(context, rf"(?i)recall\s*=\s*({_NUMBER})\s*%?", 1).try_cast("double")
    return F.when(
        col.rlike(TARGET),
        F.struct(
            key.alias("name"),
            strip_blank(part(1)).alias("display_name"),
            part(2).alias("operator"),
            part(3).cast("double").alias("target"),
            part(4).alias("unit"),
            F.when(far, "far_at_recall").otherwise("unconfigured").alias("evaluator"),
            F.when(far, F.coalesce(recall, F.lit(100.0))).alias("recall_target_pct"),
            F.when(~far, context).alias("evaluation_context"),
        ),
    )


def answers_match(answer: Column, truth: Column) -> tuple[Column, Column]:
    """Exact match of two answers, and one containing the other, without case and outer blanks."""
    a, b = F.lower(strip_blank(answer)), F.lower(strip_blank(truth))
    return a == b, F.contains(a, b) | F.contains(b, a)
