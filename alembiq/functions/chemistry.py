"""String heuristics for molecules, solvents, events and scaffolds."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .parsing import count_of, strip
from .units import event_bucket

# Solvents and their other names.
SOLVENTS = {
    "water": ("h2o", "aqueous"),
    "ethanol": ("etoh", "ethyl alcohol"),
    "methanol": ("meoh", "methyl alcohol"),
    "acetonitrile": ("mecn", "acn"),
}
# Symbols of metals.
METALS = (
    "Li", "Na", "K", "Mg", "Al", "Ti", "Cr", "Mn", "Fe", "Co", "Ni", "Cu", "Zn", "Ga", "Ge", "As", "Se", "Ru", "Rh",
    "Pd", "Ag", "Cd", "Sn", "Sb", "Te", "Pt", "Au", "Hg", "Pb",
)


def in_order(molecules: Column) -> Column:
    """The molecules sorted; lists of one are left as they are. None is null."""
    return F.when(F.size(molecules) > 1, F.sort_array(molecules)).otherwise(molecules)


def standardize(df: DataFrame, reactants: Column, products: Column, agents: Column) -> DataFrame:
    """Add reactants_canonical, products_canonical, agents_canonical and spectators_moved.

    Molecules have no white space. One on both sides is a spectator: all its
    copies leave both sides and one copy joins the agents. The lists are sorted. The spectators are a
    column that the other lists read; as a part of their expressions they would
    be found anew for every molecule, and so would the sides.
    """
    r, p, a, both = (F.col(c) for c in ("_r", "_p", "_a", "spectators_moved"))
    sides = df.withColumns({"_r": reactants, "_p": products, "_a": agents})
    found = sides.withColumn("spectators_moved", F.sort_array(F.array_intersect(r, p)))
    rest = lambda side: F.when(F.size(both) > 0, F.filter(side, lambda x: ~F.array_contains(both, x))).otherwise(side)
    lists = found.withColumns({"_r": rest(r), "_p": rest(p), "_a": F.concat(a, both)})
    ordered = {"reactants_canonical": in_order(r), "products_canonical": in_order(p), "agents_canonical": in_order(a)}
    return lists.withColumns(ordered).drop("_r", "_p", "_a")


def molecule_score(m: Column) -> Column:
    n = F.length(m) - F.length(F.translate(m, "nN", ""))
    bonus = F.when(F.contains(F.lower(m), F.lit("ar")) | F.contains(m, F.lit("c1")), 2.0).otherwise(0.0)
    return F.length(m) + bonus - n * 0.1


def main_substrate(molecules: Column) -> Column:
    """The molecule of the highest score; the first of equals."""
    scored = F.transform(molecules, lambda x, i: F.struct((-molecule_score(x)).alias("s"), i.alias("i"), x.alias("m")))
    return F.when(F.size(molecules) == 1, F.get(molecules, F.lit(0))).otherwise(F.array_min(scored)["m"])


def role_scores(molecules: Column) -> Column:
    first = F.get(molecules, F.lit(0))
    every = F.map_from_entries(F.transform(F.array_distinct(molecules), lambda x: F.struct(x, molecule_score(x))))
    return F.when(F.size(molecules) == 1, F.create_map(first, molecule_score(first))).otherwise(every)


def is_solvent(token: Column) -> Column:
    return F.lower(token).isin([*SOLVENTS, *(x for others in SOLVENTS.values() for x in others)])


def resolve_solvent(token: Column, closest: Column | None = None) -> Column:
    """struct(name, confidence): exact 1.0, other name 0.8, resembling ``closest`` 0.5, unknown 0.1."""
    t = F.lower(token)
    name, sure = F.when(t.isin(list(SOLVENTS)), t), F.when(t.isin(list(SOLVENTS)), F.lit(1.0))
    for solvent, others in SOLVENTS.items():
        name = name.when(t.isin(list(others)), F.lit(solvent))
        sure = sure.when(t.isin(list(others)), F.lit(0.8))
    if closest is not None:
        name = name.when(closest.isNotNull(), closest)
        sure = sure.when(closest.isNotNull(), F.lit(0.5))
    return F.struct(name.otherwise(t).alias("name"), sure.otherwise(F.lit(0.1)).alias("confidence"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def closest_solvents(tokens: pd.Series) -> pd.Series:
    """For each token the closest solvent name by difflib's ratio (at least 0.6), or null."""
    names = list(SOLVENTS)
    seen: dict[str, str | None] = {}

    def closest(t: str) -> str | None:
        if t not in seen:
            seen[t] = next(iter(difflib.get_close_matches(t.lower(), names, n=1)), None)
        return seen[t]

    return tokens.map(lambda some: [closest(t) for t in some])


def balanced(molecule: Column) -> Column:
    """Whether a molecule has as many closing as opening brackets, round and square ones each."""
    number = lambda c: F.length(molecule) - F.length(F.translate(molecule, c, ""))
    return (number("(") == number(")")) & (number("[") == number("]"))


def event_family(token: Column, composite: bool = True) -> Column:
    """Coarse family of an event token.

    ``composite`` is the clustering form; without it (the coherence report)
    commas are nothing special and letters are told before digits, which for
    one token comes to the same otherwise.
    """
    base = strip(F.regexp_replace(token, r"(?s):.*$", ""))
    first = F.substring(base, 1, 1)
    signed = first.isin("+", "-", "=", "#", "~")
    polarity = F.when(first == "+", "gain").when(first == "-", "loss").when(signed, "bond").otherwise("neutral")
    rest = strip(F.when(signed, F.substr(base, F.lit(2))).otherwise(base))
    letters = rest.rlike(r"^\p{L}+$")
    kind = F.when(rest == "", "other")
    if composite:
        kind = kind.when(F.contains(rest, F.lit(",")), "composite")
    kind = (
        kind.when(rest.rlike(r"\p{Nd}"), "ring_index")
        .when(letters & rest.rlike(r"\p{Lu}") & ~rest.rlike(r"\p{Ll}"), "atom_upper")
        .when(letters & rest.rlike(r"\p{Ll}") & ~rest.rlike(r"\p{Lu}"), "atom_lower")
        .when(letters, "atom_mixed")
        .when(rest.rlike(r"^[-=#]+$"), "bond_symbol")
        .when(rest.rlike(r"^[()\[\]{}]+$"), "topology")
        .otherwise("other")
    )
    return F.when(token.isNull() | (base == ""), "noop").otherwise(F.concat(polarity, F.lit(":"), kind))


def scaffold_family(scaffold: Column) -> Column:
    text = strip(F.coalesce(scaffold, F.lit("")))
    low = F.lower(text)
    metals = F.exists(F.regexp_extract_all(text, F.lit(r"\[([A-Z][a-z]?)"), F.lit(1)), lambda x: x.isin(*METALS))
    ring = low.rlike("c[1-9]")
    hetero = text.rlike("[NOSPFI]|Cl|Br") | low.rlike("[nosp]")
    return (
        F.when((text == "") | (low == "unknown"), "unknown")
        .when(F.contains(text, F.lit(".")), "multi_fragment")
        .when(metals, "organometallic")
        .when(ring & low.rlike("[nosp]"), "aromatic_hetero")
        .when(ring, "aromatic")
        .when(F.contains(text, F.lit("C")) & hetero, "aliphatic_hetero")
        .when(F.contains(text, F.lit("C")), "aliphatic")
        .when(hetero, "hetero_only")
        .otherwise("inorganic")
    )


def main_scaffold(reactants: Column, products: Column, substrate: Column) -> Column:
    first = lambda side: F.get(F.filter(side, lambda x: strip(x) != ""), F.lit(0))
    return F.coalesce(F.nullif(strip(substrate), F.lit("")), strip(first(reactants)), strip(first(products)), F.lit("unknown"))


def families(tokens: Column) -> Column:
    """The event family of every token; ``noop`` alone if there are none."""
    return F.when(F.size(tokens) > 0, F.transform(tokens, lambda t: event_family(t))).otherwise(F.array(F.lit("noop")))


def coarse_key(found: Column, scaffold: Column) -> Column:
    """struct(scaffold family, sorted families with their count buckets); ``found`` is a column of families."""
    counted = F.transform(
        F.array_sort(F.array_distinct(found)),
        lambda x: F.struct(x.alias("family"), event_bucket(count_of(found, x)).alias("bucket")),
    )
    return F.struct(scaffold_family(scaffold).alias("scaffold"), counted.alias("families"))


def coarse_text(key: Column) -> Column:
    """``scaffold|family:bucket,...``"""
    return F.concat(
        key["scaffold"], F.lit("|"), F.array_join(F.transform(key["families"], lambda x: F.concat(x["family"], F.lit(":"), x["bucket"])), ",")
    )


def coarse_json(key: Column) -> Column:
    """``{"families": [["family", "bucket"], ...], "scaffold": "..."}``; names are plain and need no escapes."""
    pairs = F.transform(key["families"], lambda x: F.concat(F.lit('["'), x["family"], F.lit('", "'), x["bucket"], F.lit('"]')))
    return F.concat(F.lit('{"families": ['), F.array_join(pairs, ", "), F.lit('], "scaffold": "'), key["scaffold"], F.lit('"}'))
