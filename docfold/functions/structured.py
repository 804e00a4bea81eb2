"""JSON, arrays and structs."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.schemas import MATCH, MATCH_VERDICT


def unfenced(x: Column) -> Column:
    """JSON without code fences and trailing commas."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(x), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", "")
    return F.regexp_replace(bare, r",\s*([}\]])", "$1")


def verdict(x: Column) -> Column:
    """A match verdict; an unknown status is the default ``new``, and ``new`` has no id."""
    v = F.from_json(unfenced(x), MATCH_VERDICT)
    known = F.coalesce(v["match_status"].isin(*MATCH), F.lit(False))
    status = F.when(known, v["match_status"]).otherwise("new")
    return F.struct(
        status.alias("match_status"),
        F.when(status != "new", v["matched_id"]).alias("matched_id"),
        F.when(known, F.coalesce(v["explanation"], F.lit(""))).otherwise("Parsing failed.").alias("explanation"),
    )


def enum_value(x: Column, names: dict[str, str]) -> Column:
    """A translation by dictionary; unknown values stay."""
    pairs = [F.lit(s) for kv in names.items() for s in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), x), x)


def scatter_gather(df: DataFrame, key: str, columns: list[str], dictionary: DataFrame) -> DataFrame:
    """Translate several columns at once: melt, look up each distinct text once, and gather back; unknown texts stay.

    ``dictionary`` has the columns source and target.
    """
    melted = df.select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("source")) for c in columns))).alias("x")).select(key, "x.*")
    texts = melted.select("source").where("source is not null").distinct().join(dictionary.dropDuplicates(["source"]), "source", "left")
    back = melted.join(texts, "source", "left").groupBy(key).agg(*(F.max(F.when(F.col("field") == c, F.coalesce("target", "source"))).alias(c) for c in columns))
    return df.drop(*columns).join(back, key, "left")


# What people read of each kind of record; ids, codes and values of lists are never translated.
READABLE = {
    "regulation": ("title", "category", "department"),
    "gap": ("obligation_text", "evidence_text", "gap_description", "control_title"),
    "requirement": ("requirement_text", "requirement_title", "risk_level", "reference"),
}


def translated(df: DataFrame, kind: str, key: str, dictionary: DataFrame) -> DataFrame:
    """Records with what people read of them translated; blank and unknown texts stay."""
    known = dictionary.where(F.length(F.trim("source")) > 0)
    return scatter_gather(df, key, [c for c in READABLE[kind] if c in df.columns], known)


def read_through(asked: DataFrame, cache: DataFrame, keys: list[str], compute) -> tuple[DataFrame, DataFrame]:
    """(answers, additions): what the cache holds, and what ``compute`` gives for the rest, once for each key, to be added to it."""
    wanted = asked.select(*keys).distinct()
    made = compute(wanted.join(cache, keys, "left_anti"))
    return asked.join(cache.unionByName(made), keys, "left"), made


def markdown(x: Column) -> Column:
    """A report that may be wrapped in JSON under one of several names."""
    bare = unfenced(x)
    return F.coalesce(*(F.get_json_object(bare, f"$.{k}") for k in ("report", "markdown", "content", "output")), bare)


def path_with_title(path: Column, title: Column) -> Column:
    """The title appended to a path unless the path ends with it."""
    return F.when(F.size(path) == 0, F.array(title)).when(F.element_at(path, -1) == title, path).otherwise(F.array_append(path, title))


#: What a reply is read as if it holds no JSON.
NO_REQUIREMENTS = '{"requirements": []}'


def _read(text: str, at: int = 0, whole: bool = False):
    """The JSON value at ``at``, or None; nesting too deep to read is no value."""
    try:
        return json.loads(text) if whole else json.JSONDecoder().raw_decode(text, at)[0]
    except (ValueError, RecursionError):
        return None


def _salvage(reply: str) -> str:
    """The whole reply if it is JSON, else the object with a list of requirements, else the object that begins at the first brace."""
    bare = re.sub(r"```[a-zA-Z]*", "", reply).strip()
    tidy = re.sub(r",\s*([}\]])", r"\1", bare)
    found = next((v for v in (_read(reply, whole=True), _read(bare, whole=True), _read(tidy, whole=True)) if v is not None), None)
    if found is None and (named := re.search(r'"requirements"\s*:\s*\[', tidy)):
        opened = [m.start() for m in re.finditer(r"\{", tidy[: named.start()])]
        objects = (_read(tidy, at) for at in reversed(opened))
        found = next((v for v in objects if isinstance(v, dict) and "requirements" in v), None)
    if found is None:
        found = _read(tidy, tidy.index("{")) if "{" in tidy else None
    try:
        return NO_REQUIREMENTS if found is None else json.dumps(found, ensure_ascii=False)
    except RecursionError:
        return NO_REQUIREMENTS


def salvage_json(x: Column) -> Column:
    """Valid JSON out of a reply with fences, trailing commas or prose around it; an empty list of requirements if there is none."""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(_salvage, na_action="ignore")

    return run(x)


def merged(*structs: Column, fields: list[list[str]]) -> Column:
    """One struct of the named fields of several; a later struct wins where names meet."""
    last = {name: s[name] for s, names in zip(structs, fields, strict=True) for name in names}
    return F.struct(*(v.alias(k) for k, v in last.items()))


def without(x: Column, *names: str) -> Column:
    """A struct without some of its fields."""
    return x.dropFields(*names)


def encoded(x: Column) -> Column:
    """JSON of a struct, an array or a map; characters beyond ASCII stay as they are."""
    return F.to_json(x, {"ignoreNullFields": "false"})
