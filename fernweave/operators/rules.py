"""Rules that correct predicted labels by keywords."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NORMAL = "normal"
EXPOSURE = "Exposure_of_Sensitive_Information_to_an_Unauthorized_Actor"
SCANNING = "Scanning_for_Vulnerable_Software"
#: Words that must not stand alone under a label, in the order in which the labels are looked at.
ANTI_WORDS = {
    "SQL_Injection": [
        "head",
        "robots",
        "bot",
        "bots",
        "bingbot",
        "googlebot",
        "requests",
        "sftp",
        "telescope",
        "vscode",
        "md",
        "delay",
        "case",
        "from",
        "pdrlabs",
        "node",
        "dockercfg",
        "python",
        "requests",
        "ckeditor",
        "xor",
        "view",
        "getlist",
        "now",
        "pw",
    ],
    "Cross_Site_Scripting": [
        "now",
        "robots",
        "bot",
        "bots",
        "bingbot",
        "googlebot",
        "yisouspider",
        "ssh",
        "adsbot",
        "asc",
        "python",
        "requests",
    ],
    "Client_Server_Protocol_Manipulation": ["head"],
}
#: Words that mean exposure or scanning.
EXPOSURE_WORDS, SCANNING_WORDS = ["crawler", "recon", "yisouspider"], ["owa"]


def any_of(present: Column, words: list[str]) -> Column:
    return F.arrays_overlap(present, F.array(*[F.lit(w) for w in words])) if words else F.lit(False)


def only(present: Column, words: list[str]) -> Column:
    return F.size(F.array_except(present, F.array(*[F.lit(w) for w in words]).cast("array<string>"))) == 0


def bypassed(label: Column, present: Column, vocabulary: list[str], anti: dict[str, list[str]] = ANTI_WORDS) -> Column:
    """A label corrected where only its anti-words are present.

    ``present`` holds the words of ``vocabulary`` whose weight is above zero.
    Labels are looked at in the order of ``anti``, each seeing what the ones
    before made of it.
    """
    known = set(vocabulary)
    for name, words in anti.items():
        own = [w for w in dict.fromkeys(words) if w in known]
        alone = any_of(present, own) & only(present, own)
        new = (
            F.when(any_of(present, [w for w in EXPOSURE_WORDS if w in known]), EXPOSURE)
            .when(any_of(present, [w for w in SCANNING_WORDS if w in known]) & only(present, SCANNING_WORDS), SCANNING)
            .otherwise(NORMAL)
        )
        label = F.when((label == name) & alone, new).otherwise(label)
    return label


def head_bypassed(label: Column, present: Column) -> Column:
    """An anomaly whose only keyword is ``head`` is normal."""
    return F.when((label == "anomaly") & any_of(present, ["head"]) & only(present, ["head"]), NORMAL).otherwise(label)


def collapsed(label: Column) -> Column:
    """attack or normal."""
    return F.when(label != NORMAL, "attack").otherwise(label)


def as_normal(label: Column, labels: list[str]) -> Column:
    return F.when(label.isin(labels), NORMAL).otherwise(label)


def rechecked(df: DataFrame, second: DataFrame, key: str, label: str = "ai_label") -> DataFrame:
    """Labels overwritten by those of ``second`` where it has the key."""
    new = second.select(F.col(key).alias("__k"), F.col(label).alias("__new"))
    return df.join(new, F.col(key) == F.col("__k"), "left").withColumn(label, F.coalesce("__new", label)).drop("__k", "__new")


def split_rule(rule: str) -> list[str]:
    """The alternatives of ``and((position(c, 'a|b') != 0) or (...))`` as one ``and (position(c, 'a') != 0)`` each."""
    out = []
    for part in rule.strip().removeprefix("and((").removesuffix("))").split(") or ("):
        m = re.fullmatch(r"\s*(?P<head>.*?), '(?P<words>[^']*)'\)\s*(?P<tail>.*?)\s*", part)
        if m:
            out += [f"and ({m['head']}, '{w}') {m['tail']})" for w in m["words"].split("|")]
    return out
