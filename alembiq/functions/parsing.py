"""Parsing of text fields into arrays, maps and numbers. Blank, NaN and null are all null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\x0b\f"
TEXTS = "array<string>"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def no_texts() -> Column:
    return F.array().cast(TEXTS)


def clean(items: Column) -> Column:
    """Trim every element and leave out blank and null ones."""
    return F.filter(F.transform(items, strip), lambda x: x.isNotNull() & (x != ""))


def json_texts(c: Column) -> Column:
    """A JSON list of text as an array, else null."""
    return F.from_json(F.when(strip(c).startswith("["), strip(c)), TEXTS)


def separator(by: str) -> str:
    """A pattern of the separator with the blanks around it; a run of blanks is entered at its start only, so that long ones take no square."""
    return f"(?:(?<![{BLANKS}])[{BLANKS}]++)?[{by}][{BLANKS}]*"


def divided(s: Column, single: Column) -> Column:
    """Trimmed text split at the first present of ; | , and else ``single``; no element is blank or has blanks around it.

    Blanks go with the separators, so that no element is trimmed by itself.
    """
    at = lambda by: F.split(s, separator(by))
    parts = F.when(F.contains(s, F.lit(";")), at(";")).when(F.contains(s, F.lit("|")), at("|")).when(F.contains(s, F.lit(",")), at(",")).otherwise(single)
    return F.array_remove(parts, "")


def at_stops(s: Column) -> Column:
    return F.when(F.contains(s, F.lit(".")), F.split(s, separator("."))).when(s.isNotNull(), F.array(s))


def listed_entities(s: Column) -> Column:
    """A JSON list in brackets, else null."""
    return clean(F.when(s.startswith("[") & s.endswith("]"), F.from_json(s, TEXTS)))


def split_entities(c: Column) -> Column:
    """JSON list in brackets; else split at the first present of ; | , and else at full stops."""
    s = strip(c)
    return F.coalesce(listed_entities(s), divided(s, at_stops(s)), no_texts())


def split_molecules(s: Column) -> Column:
    """``split_entities`` of trimmed text, without any white space in the elements."""
    bare = F.translate(s, BLANKS, "")
    return F.coalesce(without_blanks(listed_entities(s)), divided(bare, at_stops(bare)), no_texts())


def without_blanks(items: Column) -> Column:
    return F.transform(items, lambda x: F.translate(x, BLANKS, ""))


def tokenize(c: Column) -> Column:
    """Like ``split_entities`` but a text without separator is one token."""
    s = strip(c)
    return F.coalesce(clean(json_texts(s)), divided(s, F.when(s.isNotNull(), F.array(s))), no_texts())


def to_list(c: Column) -> Column:
    """JSON list with its elements as they are, nulls left out, or the trimmed text as one token."""
    return F.coalesce(F.filter(json_texts(c), lambda x: x.isNotNull()), F.when(blank_to_null(c).isNotNull(), F.array(strip(c))), no_texts())


def ensure_list(c: Column) -> Column:
    """JSON list, or split at every ; and , alike."""
    return F.coalesce(clean(F.coalesce(json_texts(c), F.split(c, "[;,]"))), no_texts())


def strict_ids(c: Column) -> Column:
    """JSON or delimited ids as longs; a bad token is an error."""
    return F.transform(ensure_list(c), lambda x: x.cast("long"))


def lenient_ids(c: Column) -> Column:
    """JSON or delimited ids as longs, "3.0" included and cut towards zero; bad tokens are left out."""
    return F.filter(F.transform(ensure_list(c), lambda x: x.try_cast("double").try_cast("long")), lambda x: x.isNotNull())


def json_counts(c: Column) -> Column:
    """JSON object of counts as a map; a JSON list counts its elements; other text counts once."""
    s = blank_to_null(c)
    listed = json_texts(s)
    tally = F.map_from_entries(
        F.transform(F.array_distinct(listed), lambda x: F.struct(x, F.size(F.filter(listed, lambda y: y == x)).cast("long")))
    )
    as_map = F.from_json(F.when(s.startswith("{"), s), "map<string,bigint>")
    return F.coalesce(as_map, tally, F.when(s.isNotNull(), F.create_map(s, F.lit(1).cast("long"))))


def coarse_key(c: Column) -> Column:
    """struct(scaffold, families of struct(family, bucket)) of a coarse key as JSON text; other text is the scaffold alone."""
    s = blank_to_null(c)
    read = F.from_json(s, "scaffold string, families array<array<string>>")
    is_json = F.try_parse_json(s).isNotNull()
    families = F.transform(F.filter(read["families"], lambda x: F.size(x) >= 2), lambda x: F.struct(x[0].alias("family"), x[1].alias("bucket")))
    none = F.array().cast("array<struct<family:string,bucket:string>>")
    return F.struct(
        F.when(is_json, read["scaffold"]).when(s.isNotNull(), c).alias("scaffold"), F.when(is_json, F.coalesce(F.array_sort(families), none)).otherwise(none).alias("families")
    )


def split_component(c: Column) -> Column:
    """Molecules of one side of a reaction string."""
    return F.coalesce(F.array_remove(at_stops(strip(c)), ""), no_texts())


def parse_reaction(c: Column) -> Column:
    """struct(reactants, agents, products) of ``A.B>agents>P|more agents`` or ``A.B>>P``-like text.

    Three parts are reactants, agents, products; two are reactants and
    products; any other number is all empty.
    """
    parts = F.split(strip(c), ">")
    n = F.size(parts)
    known = n.isin(2, 3)
    last = F.when(known, F.get(parts, n - 1))
    tail = F.split(last, "[|]", 2)
    middle = F.when(n == 3, F.get(parts, F.lit(1)))
    return F.struct(
        split_component(F.when(known, F.get(parts, F.lit(0)))).alias("reactants"),
        F.concat(split_component(middle), split_component(F.get(tail, F.lit(1)))).alias("agents"),
        split_component(F.get(tail, F.lit(0))).alias("products"),
    )


def key_json(items: Column, pairs: bool = False) -> Column:
    """Sorted distinct non-empty values as compact JSON; ``pairs`` writes [name,null] for each."""
    values = F.array_sort(F.array_distinct(clean(items)))
    return F.to_json(F.transform(values, lambda x: F.array(x, F.lit(None).cast("string"))) if pairs else values)


def count_of(items: Column, x: Column) -> Column:
    return F.size(F.filter(items, lambda y: y == x))


def characters(molecules: Column) -> Column:
    """The characters of all molecules, blanks left out."""
    return F.filter(F.split(F.array_join(molecules, ""), ""), lambda x: ~x.rlike(r"^\s*$"))


def multiset_delta(a: Column, b: Column) -> Column:
    """Gains ``+c:n`` in order of c, then losses ``-c:n``, between two arrays of characters.

    Each distinct character is counted in the joined texts by what leaving it
    out shortens them: passes over a string, as many as the alphabet has
    characters.
    """
    texts = F.struct(F.array_join(a, "").alias("a"), F.array_join(b, "").alias("b"), F.array_sort(F.array_distinct(F.concat(a, b))).alias("every"))
    shorter = lambda t, x: F.length(F.replace(t, x, F.lit("")))

    def changes(s: Column) -> Column:
        longer = F.length(s["b"]) - F.length(s["a"])
        return F.transform(s["every"], lambda x: F.struct(x.alias("c"), (longer - shorter(s["b"], x) + shorter(s["a"], x)).alias("n")))

    def events(change: Column) -> Column:
        some = F.filter(change, lambda x: x["n"] != 0)
        ordered = F.array_sort(F.transform(some, lambda x: F.struct((x["n"] < 0).alias("loss"), x["c"].alias("c"), F.abs(x["n"]).alias("n"))))
        return F.transform(ordered, lambda x: F.concat(F.when(x["loss"], "-").otherwise("+"), x["c"], F.lit(":"), x["n"].cast("string")))

    # an array of one element names the texts, so that they are made once
    return events(F.transform(F.array(texts), changes)[0])
