"""Parts of a job text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.functions import text as tx
from fitmill.operators.entities import title_strings
from fitmill.rules import patterns as pt
from fitmill.rules.wordlists import DEFAULT_TITLE


def labelled_title(text: Column) -> Column:
    """The text after a title label, else the first line."""
    regex = rx.expand(pt.TITLE_LABEL, "i")
    first_line = F.get(F.split(rx.strip(text), "\n", 2), F.lit(0))
    return rx.strip(F.when(text.rlike(regex), F.regexp_extract(text, regex, 1)).otherwise(first_line))


def requirements(text: Column) -> Column:
    """Bullet items between a requirements word and a nice-to-have word or the end."""
    return tx.bullet_items(F.regexp_extract(text, rx.expand(pt.REQUIREMENTS_BLOCK, "is"), 1))


def nice_to_have(text: Column) -> Column:
    """Bullet items after a nice-to-have word."""
    return tx.bullet_items(F.regexp_extract(text, rx.expand(pt.NICE_BLOCK, "is"), 1))


def found_title(text: Column) -> Column:
    """The first known job title in the text, else a default."""
    return F.coalesce(F.get(title_strings(text), F.lit(0)), F.lit(DEFAULT_TITLE))
