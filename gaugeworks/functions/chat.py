"""Turns of a conversation: role and text under either spelling, the prompt and the answer's label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks.functions.labels import clean_label
from gaugeworks.functions.paths import strip_blank

TURN = "from string, value string, role string, content string"
HUMAN, ASSISTANT = ("human", "user"), ("gpt", "assistant")


def role(turn: Column) -> Column:
    return F.lower(F.coalesce(turn["from"], turn["role"]))


def value(turn: Column) -> Column:
    return F.coalesce(turn["value"], turn["content"])


def prompt(turns: Column) -> Column:
    """The first human turn's text, stripped; null without one."""
    return strip_blank(value(F.try_element_at(F.filter(turns, lambda t: role(t).isin(*HUMAN)), F.lit(1))))


def answer(turns: Column) -> Column:
    """The last assistant turn's text, cleaned; null unless it's OK or NG."""
    text = clean_label(value(F.try_element_at(F.filter(turns, lambda t: role(t).isin(*ASSISTANT)), F.lit(-1))))
    return F.when(text.isin("OK", "NG"), text)


def without_media(text: Column) -> Column:
    return strip_blank(F.regexp_replace(text, r"<(?:video|image)>", ""))


def record(images: Column, prompt_: Column, label: Column, id_: Column) -> Column:
    """A two-turn record of images, prompt and label."""
    turn = lambda who, text: F.struct(F.lit(who).alias("from"), text.alias("value"))
    return F.struct(id_.alias("id"), images.alias("images"), F.array(turn("human", prompt_), turn("gpt", label)).alias("conversations"))
