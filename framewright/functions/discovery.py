"""Object queries from instruction text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vocabularies.
VERBS = ("close", "drop", "flip", "grasp", "insert", "lift", "move", "open", "pick", "place", "pull", "push", "put", "remove", "retrieve", "rotate", "slide", "stack", "turn")
COLORS = ("black", "blue", "brown", "gray", "green", "grey", "orange", "pink", "purple", "red", "white", "yellow")
NOUNS = ("ball", "block", "bottle", "bowl", "box", "button", "can", "cube", "cup", "cylinder", "drawer", "fork", "handle", "knife", "plate", "spoon", "toy")
GENERIC = ("item", "items", "object", "objects", "thing", "things", "toy", "toys")
MOCK_COLORS = ("black", "blue", "green", "red", "white", "yellow")
MOCK_NOUNS = ("block", "bottle", "bowl", "box", "can", "cup", "drawer", "fork", "knife", "plate", "spoon", "toy")

GAP = r"(?U)[\s\x1c-\x1f]+"
THE = r"(?U)\bthe\s+(\w(?:[\w\s]*\w)?)\b"  # a character class, so that long phrases need no recursion


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, GAP, " "))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def the_phrases(text: Column) -> Column:
    """Phrases after "the", unless their last word is a verb."""
    found = F.regexp_extract_all(F.lower(text), F.lit(THE), F.lit(1))
    return F.filter(found, lambda p: ~F.element_at(F.split(collapsed(p), " "), -1).isin(*VERBS))


def color_phrases(text: Column) -> Column:
    """A color and the word after it, unless that is a verb; color by color,
    since the matches of two colors may overlap."""

    def of(color: str) -> Column:
        found = F.regexp_extract_all(F.lower(text), F.lit(rf"(?U)\b{color}\s+(\w+)\b"), F.lit(1))
        return F.transform(F.filter(found, lambda w: ~w.isin(*VERBS)), lambda w: F.concat(F.lit(f"{color} "), w))

    return F.concat(*[of(c) for c in COLORS])


def noun_hits(text: Column) -> Column:
    return F.filter(_strings(NOUNS), lambda n: F.regexp(F.lower(text), F.concat(F.lit(r"(?U)\b"), n, F.lit(r"s?\b"))))


def without_articles(queries: Column) -> Column:
    """Articles out anywhere, gaps collapsed, blanks out, distinct, sorted."""
    plain = F.transform(queries, lambda q: collapsed(F.regexp_replace(collapsed(q), r"(?U)\b(a|an|the)\b[\s]*", "")))
    return F.array_sort(F.array_distinct(F.filter(plain, lambda q: q != "")))


def finished(queries: Column, always: list[str] = ()) -> Column:
    """Every extractor's last step: with ``always``, lower-cased, collapsed,
    without blanks, distinct, sorted."""
    plain = F.transform(F.concat(queries, _strings(always)), lambda q: F.lower(collapsed(q)))
    return F.array_sort(F.array_distinct(F.filter(plain, lambda q: q != "")))


def rule_queries(text: Column, always: list[str] = ()) -> Column:
    found = F.concat(the_phrases(text), color_phrases(text), noun_hits(text), _strings(a.lower() for a in always))
    return finished(without_articles(found), always)


def mock_queries(text: Column, always: list[str] = ()) -> Column:
    """Keywords by word, each after its color if one precedes it."""
    words = F.transform(F.split(collapsed(F.lower(text)), " "), lambda w: F.regexp_replace(w, r"\A[.,!?]+|[.,!?]+\z", ""))

    def named(w: Column, i: Column) -> Column:
        before = F.get(words, i - 1)
        return F.when(w.isin(*MOCK_NOUNS, *MOCK_COLORS), F.when((i > 0) & before.isin(*MOCK_COLORS), F.concat_ws(" ", before, w)).otherwise(w))

    return finished(F.filter(F.transform(words, named), lambda q: q.isNotNull()), always)


def without_fence(text: Column) -> Column:
    plain = F.regexp_replace(text, r"\A\s+|\s+\z", "")
    inner = F.regexp_extract(plain, r"(?is)\A```(?:json)?\s*(.*?)\s*```\z", 1)
    return F.when(F.regexp(plain, F.lit(r"(?is)\A```(?:json)?\s*(.*?)\s*```\z")), inner).otherwise(plain)


def response_labels(response: Column) -> Column:
    """Labels of a model's JSON array; null if there is none.  Only strings
    count; one leading article and generic names go."""
    text = without_fence(response)
    whole = F.try_parse_json(text)
    cut = F.try_parse_json(F.regexp_extract(text, r"(?s)\[.*\]", 0))
    parsed = F.coalesce(whole, cut)
    items = F.expr("null")
    is_list = F.schema_of_variant(parsed).startswith("ARRAY")
    items = F.when(is_list, F.try_variant_get(parsed, "$", "array<variant>"))
    texts = F.transform(F.filter(items, lambda v: F.schema_of_variant(v) == "STRING"), lambda v: F.lower(collapsed(F.try_variant_get(v, "$", "string"))))
    bare = F.transform(texts, lambda q: F.regexp_replace(q, r"\A(?:a|an|the)\s+", ""))
    return F.array_sort(F.array_distinct(F.filter(bare, lambda q: (q != "") & ~q.isin(*GENERIC))))


EXTRACTORS = {"rule": rule_queries, "mock": mock_queries}


def extractor(name: str):
    if name not in EXTRACTORS:
        raise ValueError(f"unknown extractor {name!r}; there are {', '.join(sorted(EXTRACTORS))}, manual and qwen")
    return EXTRACTORS[name]
