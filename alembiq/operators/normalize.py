"""Raw reactions to normalized, deduplicated and numbered ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chemistry as chem
from ..functions import parsing as p
from ..functions import units
from ..functions.hashing import hex_digest, parity_state
from ..shared import cut
from . import profile

# The columns that can hold a condition, in order of preference, and the unit each implies.
ALIASES: dict[str, list[tuple[str, str | None]]] = {
    "temperature": [
        ("temperature", None), ("temperature_c", "C"), ("temp_c", "C"), ("temperature_f", "F"), ("temp_f", "F"),
        ("temperature_k", "K"), ("temp_k", "K"),
    ],
    "time": [
        ("time", None), ("time_min", "min"), ("time_mins", "min"), ("time_minutes", "min"), ("time_hr", "h"), ("time_h", "h"),
        ("time_hours", "h"), ("duration", None), ("duration_min", "min"), ("duration_hr", "h"), ("time_s", "s"),
        ("time_sec", "s"), ("time_secs", "s"),
    ],
    "pressure": [
        ("pressure", None), ("pressure_pa", "Pa"), ("pressure_kpa", "kPa"), ("pressure_mpa", "MPa"), ("pressure_atm", "atm"),
        ("pressure_bar", "bar"), ("pressure_mbar", "mbar"), ("pressure_torr", "torr"), ("pressure_psi", "psi"),
    ],
    "atmosphere": [("atmosphere", None), ("atmosphere_type", None), ("atm", None)],
    "light": [("light", None), ("irradiation", None), ("illumination", None)],
    "pH": [("pH", None), ("ph", None)],
    "phase": [("phase", None), ("state", None)],
    "solvent": [("solvent", None), ("solvents", None)],
}
REACTION_TEXTS = ("rxn_smiles", "reaction_smiles", "rxn")
SIDES = ("reactants", "products", "agents", "catalysts")
#: Columns of ``normalize`` that belong to a raw row; all others follow from its sides, reaction texts and conditions.
OF_A_ROW = ("rxn_id", "yield", "source", "timestamp", "provenance")


class Fields:
    """Columns of an open schema by exact name, as text; arrays become JSON text, missing columns null.

    Names that differ in case only (pH and ph) are different columns, which
    Spark can't tell apart by name: ``df`` is the table with columns named by
    position. Of columns with the same name the first counts.
    """

    def __init__(self, df: DataFrame):
        self.df = df.toDF(*[f"f{i}" for i in range(len(df.columns))])
        self.names: dict[str, tuple[str, str]] = {}
        for own, (name, kind) in zip(self.df.columns, df.dtypes, strict=True):
            self.names.setdefault(name, (own, kind))

    def has(self, name: str) -> bool:
        return name in self.names

    def col(self, name: str) -> Column:
        return F.col(self.names[name][0])

    def text(self, name: str) -> Column:
        if name not in self.names:
            return F.lit(None).cast("string")
        kind, c = self.names[name][1], self.col(name)
        if kind.startswith("array"):
            listed = p.clean(F.transform(c, lambda x: x.cast("string")))
            return F.when(F.size(listed) > 0, F.to_json(listed))
        if kind in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        return p.blank_to_null(c.cast("string"))


def condition(fields: Fields, name: str) -> Column:
    """The first condition column that is not missing, with the unit its name implies unless the text has letters."""
    found = []
    for column, unit in ALIASES[name]:
        if fields.has(column):
            c = fields.text(column)
            found.append(F.when(c.rlike(r"\p{L}"), c).otherwise(F.concat(c, F.lit(f" {unit}"))) if unit else c)
    return F.coalesce(*found, F.lit(None).cast("string"))


def components(df: DataFrame, reaction_texts: list[str]) -> DataFrame:
    """Fill reactants, products and rxn_agents from the first reaction text that parses, where columns don't give both sides."""
    parsed = F.lit(None).cast("struct<reactants:array<string>,agents:array<string>,products:array<string>>")
    for name in reversed(reaction_texts):
        parsed = F.when((F.size(f"{name}.reactants") > 0) | (F.size(f"{name}.products") > 0), F.col(name)).otherwise(parsed)
    df = df.withColumn("parsed", parsed)
    given = (F.size("reactants") > 0) & (F.size("products") > 0)
    fill = lambda c: F.when(F.size(c) > 0, F.col(c)).otherwise(F.coalesce(F.col(f"parsed.{c}"), p.no_texts()))
    agents = F.when(given, p.no_texts()).otherwise(F.coalesce("parsed.agents", p.no_texts()))
    return df.withColumns({"reactants": fill("reactants"), "products": fill("products"), "rxn_agents": agents})


def solvents(tokens: Column, closest: Column | None = None) -> Column:
    """array<struct(name, confidence)> of a solvent field's tokens; ``closest`` has the solvent that each token resembles, or null.

    One token, the commonest case, goes by compiled code.
    """
    like = lambda i: None if closest is None else F.get(closest, i)
    every = F.transform(tokens, lambda t, i: chem.resolve_solvent(t, like(i)))
    return F.when(F.size(tokens) == 1, F.array(chem.resolve_solvent(F.get(tokens, F.lit(0)), like(F.lit(0))))).otherwise(every)


def confidence(found: Column) -> Column:
    """The mean confidence of ``solvents``, 0 without any."""
    total = F.aggregate(found, F.lit(0.0), lambda a, x: a + x["confidence"])
    one = F.when(F.size(found) == 1, F.get(found, F.lit(0))["confidence"])
    return one.when(F.size(found) > 0, total / F.size(found)).otherwise(0.0)


def learn_fuzzy(raw: DataFrame) -> DataFrame:
    """(solvent_text, closest): the solvents that the tokens of each distinct solvent text resemble, where any does.

    Texts are compared once however many rows have them, and ``normalize``
    joins the table by the text, so that it has no bound. The distinct texts
    are a table first: Spark would move the comparison below ``distinct``, to
    every row.
    """
    f = Fields(raw)
    texts = cut(f.df.select(condition(f, "solvent").alias("solvent_text")).distinct(), "solvents")
    asked = texts.withColumn("tokens", p.tokenize(F.col("solvent_text"))).filter(F.exists("tokens", lambda t: ~chem.is_solvent(t)))
    found = asked.select("solvent_text", chem.closest_solvents("tokens").alias("closest"))
    return cut(found.filter(F.exists("closest", lambda x: x.isNotNull())), "fuzzy")


def normalize(raw: DataFrame, fuzzy: DataFrame | None = None, hash_mode: str = "sha2", ordinal: str | None = None) -> DataFrame:
    """One row per raw reaction with canonical sides, conditions, hash and ``failures``.

    present_mask has bit i set if any column of condition i is not missing,
    parsable or not.

    ``ordinal`` names a column with the input order; without it the order is
    the scan's, and a stream has none. Missing columns are null; columns whose
    names differ in case only are different ones. ``fuzzy`` is the table of
    ``learn_fuzzy``. Rows whose sides are empty, before or after spectators
    leave, have the failure ``missing_reaction_components``; others with a
    molecule, spectators aside, whose brackets are unbalanced have
    ``molecule_standardization``.
    """
    f = Fields(raw)
    raw = f.df
    order = f.col(ordinal) if ordinal else F.lit(0).cast("long") if raw.isStreaming else F.monotonically_increasing_id()
    other = lambda name: f.col(name) if f.has(name) else F.lit(None).cast("string")
    texts = [c for c in REACTION_TEXTS if f.has(c)]
    # Each step works on columns of the one before, so that no expression is planned or evaluated twice.
    fields = raw.select(
        order.alias("ord"),
        *[f.text(c).alias(c) for c in ("rxn_id", *SIDES, "source", *texts)],
        *[condition(f, c).alias(f"c_{c}") for c in ALIASES],
        f.text("yield").alias("yield"),
        other("timestamp").alias("timestamp"),
    )
    if fuzzy is not None:
        fields = fields.join(fuzzy, F.col("c_solvent") == F.col("solvent_text"), "left")
    lists = fields.withColumns(
        {c: p.split_molecules(F.col(c)) for c in SIDES}
        | {c: p.parse_reaction(F.translate(F.col(c), p.BLANKS, "")) for c in texts}
        | {f"q_{c}": F.struct(*[x.alias(n) for x, n in zip(units.value_and_unit(F.col(f"c_{c}")), "vu", strict=True)]) for c in ("temperature", "time", "pressure")}
        | {"tokens": p.tokenize(F.col("c_solvent"))}
    ).withColumn("solvents", solvents(F.col("tokens"), None if fuzzy is None else F.col("closest")))
    quantity = lambda c: (F.col(f"q_{c}.v"), F.col(f"q_{c}.u"))
    sided = chem.standardize(components(lists, texts), F.col("reactants"), F.col("products"), F.concat("agents", "catalysts", "rxn_agents"))
    own = F.concat("reactants_canonical", "products_canonical", F.array_except("agents_canonical", "spectators_moved"))
    empty = (F.size("reactants_canonical") == 0) | (F.size("products_canonical") == 0)
    join = lambda c: F.array_join(c, ".")
    reaction = F.concat(join("reactants_canonical"), F.lit(">>"), join("products_canonical"), F.lit("|"), join("agents_canonical"))
    out = sided.withColumn("reaction", reaction).select(
        "ord",
        "rxn_id",
        "reactants_canonical",
        "products_canonical",
        "agents_canonical",
        "spectators_moved",
        chem.main_substrate(F.col("reactants_canonical")).alias("role_main_substrate"),
        chem.role_scores(F.col("reactants_canonical")).alias("role_scores"),
        units.kelvin(*quantity("temperature")).alias("temperature_K"),
        units.scaled(*quantity("time"), units.SECONDS).alias("time_s"),
        units.scaled(*quantity("pressure"), units.PASCALS).alias("pressure_Pa"),
        F.col("solvents.name").alias("solvent_normalized"),
        confidence(F.col("solvents")).alias("solvent_confidence"),
        F.col("c_atmosphere").alias("atmosphere"),
        F.col("c_light").alias("light"),
        F.col("c_phase").alias("phase"),
        units.plain_number(F.col("c_pH")).alias("pH"),
        units.plain_number(F.col("yield")).alias("yield"),
        "source",
        "timestamp",
        sum((F.when(F.col(f"c_{c}").isNotNull(), F.lit(1 << i)).otherwise(0) for i, c in enumerate(ALIASES)), F.lit(0)).alias("present_mask"),
        F.when(empty, F.array(F.lit("missing_reaction_components")))
        .when(F.col("reaction").rlike(r"[()\[\]]") & F.exists(own, lambda m: ~chem.balanced(m)), F.array(F.lit("molecule_standardization")))
        .otherwise(p.no_texts())
        .alias("failures"),
        "reaction",
    )
    fields = F.struct("atmosphere", "light", "pH", "phase", "pressure_Pa", F.col("solvent_normalized").alias("solvent"), "temperature_K", "time_s")
    state = parity_state(fields) if hash_mode == "parity" else F.to_json(fields, {"ignoreNullFields": "false"})
    return out.withColumns(
        {
            "reaction_hash_v1": hex_digest(F.concat("reaction", F.lit("||"), state), hash_mode),
            "resolution_confidence": F.col("solvent_confidence"),
            "provenance": F.when(F.col("rxn_id").isNull(), p.no_texts()).otherwise(F.array("rxn_id")),
        }
    ).drop("reaction")


def split_failures(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, failures as rxn_id, failures, source)."""
    bad = normalized.filter(F.size("failures") > 0).select("rxn_id", "failures", "source")
    return normalized.filter(F.size("failures") == 0).drop("failures"), bad


def provenance_rows(good: DataFrame) -> DataFrame:
    """(reaction_hash_v1, ord, rxn_id): one row per source of a reaction; the long form of provenance, which no hot hash outgrows."""
    return good.select("reaction_hash_v1", "ord", "rxn_id")


def deduplicate(good: DataFrame) -> DataFrame:
    """The first row of each reaction hash, with the rxn_ids of all in input order as provenance."""
    rest = [c for c in good.columns if c not in ("reaction_hash_v1", "provenance")]
    sources = F.array_sort(F.collect_list(F.struct("ord", F.get("provenance", F.lit(0)).alias("id"))))
    merged = good.groupBy("reaction_hash_v1").agg(
        F.min_by(F.struct(*rest), "ord").alias("r"), F.transform(sources, lambda x: x["id"]).alias("provenance")
    )
    return merged.select("reaction_hash_v1", "r.*", "provenance").select(*good.columns)


def distinct_rows(raw: DataFrame, ordinal: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The first of all raw rows with equal sides, reaction texts and conditions, as a table: ord, these columns as text, ``keep``.

    Rows with equal texts have equal hashes and failures, so that they need
    normalizing once. The aggregation combines before its shuffle. Its key is
    one struct of the texts as they are: ``normalize`` trims them, and texts
    that differ in blanks meet again under their reaction hash.
    """
    f = Fields(raw)
    read = [c for c in (*SIDES, *REACTION_TEXTS, *(c for names in ALIASES.values() for c, _ in names)) if f.has(c)]
    kept = [c for c in keep if f.has(c)]
    own, extra = [f"t{i}" for i in range(len(read))], [f"k{i}" for i in range(len(kept))]
    order = f.col(ordinal) if ordinal else F.monotonically_increasing_id()
    plain = lambda c: f.col(c) if f.names[c][1] == "string" else f.text(c)
    texts = F.struct(F.lit(0).alias("t"), *[plain(c).alias(t) for c, t in zip(read, own, strict=True)])
    rows = f.df.select(order.alias("ord"), texts.alias("texts"), *[f.col(c).alias(k) for c, k in zip(kept, extra, strict=True)])
    first = rows.groupBy("texts").agg(F.min("ord").alias("first"), *[F.min_by(k, "ord").alias(k) for k in extra])
    # a table by place, as files can't have names that differ in case only
    return cut(first.select("first", *[f"texts.{t}" for t in own], *extra), "distinct-rows").toDF("ord", *read, *kept)


def distinct_table(raw: DataFrame, hash_mode: str = "sha2", ordinal: str | None = None, fuzzy: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``normalize`` of ``distinct_rows`` as a table, without the columns of a raw row but ``keep``.

    The rows are dealt out again, as a few small files are read by few tasks,
    whatever their rows cost.
    """
    rows = distinct_rows(raw, ordinal, keep)
    table = normalize(rows.repartition("ord"), learn_fuzzy(rows) if fuzzy else None, hash_mode, "ord")
    return cut(table.drop(*[c for c in OF_A_ROW if c not in keep]), "normalized")


def reactions(raw: DataFrame, hash_mode: str = "sha2", ordinal: str | None = None, fuzzy: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """The reactions of ``phase0`` without the columns of a raw row but ``keep`` (of the reaction's first row).

    Raw rows are made distinct before they are normalized, so that the cost of
    that step grows with the distinct texts, not with the rows.
    """
    good = distinct_table(raw, hash_mode, ordinal, fuzzy, keep).filter(F.size("failures") == 0).drop("failures")
    rest = [c for c in good.columns if c != "reaction_hash_v1"]
    merged = good.groupBy("reaction_hash_v1").agg(F.min_by(F.struct(*rest), "ord").alias("r"))
    return number(merged.select("reaction_hash_v1", "r.*").select(*good.columns), "reaction_hash_v1", "rxn_vid")


def number(df: DataFrame, key: str, name: str) -> DataFrame:
    """Add the 1-based rank of unique ``key`` without a single-task window.

    Rows are range-partitioned and sorted; each partition's size becomes an
    offset of the next. Partition numbers and places are fixed in a table
    first; the sizes, one row per partition, are summed and broadcast.
    """
    place = df.repartitionByRange(key).sortWithinPartitions(key)
    id_ = F.monotonically_increasing_id()
    fixed = cut(place.withColumns({"_part": F.shiftright(id_, 33), "_place": id_.bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    sizes = fixed.groupBy("_part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    return fixed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_place") + F.col("_before") + 1).drop("_part", "_place", "_before")


def default_ids(table: DataFrame, first_place: int = 0) -> DataFrame:
    """Rows without rxn_id get their 0-based place in the input order, as text, as id and provenance; places start at ``first_place``.

    Places are counted only if an id is missing: rows are range-partitioned by
    their order, and each partition's size becomes an offset of the next.
    """
    if table.filter("rxn_id is null").isEmpty():
        return table
    placed = number(table, "ord", "_nth")
    own = F.coalesce("rxn_id", (F.col("_nth") + (first_place - 1)).cast("string"))
    return placed.withColumn("provenance", F.array(own)).withColumn("rxn_id", own).drop("_nth")


def normalized_table(raw: DataFrame, hash_mode: str = "sha2", ordinal: str | None = None, fuzzy: bool = True, first_place: int = 0) -> DataFrame:
    """``normalize`` as a table, every row with an id.

    It is a table because a filter on ``failures`` isn't pushed below the
    expressions that make it, where it would evaluate them twice.
    """
    return default_ids(cut(normalize(raw, learn_fuzzy(raw) if fuzzy else None, hash_mode, ordinal), "normalized"), first_place)


def phase0(raw: DataFrame, hash_mode: str = "sha2", ordinal: str | None = None, fuzzy: bool = True) -> tuple[DataFrame, DataFrame]:
    """(normalized reactions with rxn_vid, failures)."""
    table = normalized_table(raw, hash_mode, ordinal, fuzzy)
    good, bad = split_failures(table)
    return number(deduplicate(good), "reaction_hash_v1", "rxn_vid"), bad


def failure_counts(normalized: DataFrame) -> DataFrame:
    """(failure, n)."""
    return normalized.select(F.explode("failures").alias("failure")).groupBy("failure").agg(F.count("*").alias("n"))


def warnings(normalized: DataFrame, least: float = 0.99) -> DataFrame:
    """(warning): one row if the share of rows without failure is below ``least``."""
    ratio = F.try_divide(F.count_if(F.size("failures") == 0), F.count("*"))
    low = normalized.agg(ratio.alias("ratio")).filter(F.col("ratio") < least)
    return low.select(F.concat(F.lit("success ratio "), F.format_number("ratio", 2), F.lit(f" < {least}")).alias("warning"))


def summary(normalized: DataFrame) -> DataFrame:
    """One row of counts over all rows that did not fail, before deduplication, and the success ratio (null without rows)."""
    ok = F.size("failures") == 0
    size = lambda c: F.when(ok, F.size(c))
    return normalized.agg(
        F.count("*").alias("n_rows"),
        F.count_if(ok).alias("n_ok"),
        F.round(F.try_divide(F.count_if(ok), F.count("*")), 6).alias("success_ratio"),
        F.count_distinct(F.when(ok, F.col("reaction_hash_v1"))).alias("n_distinct"),
        (F.count_if(ok) - F.count_distinct(F.when(ok, F.col("reaction_hash_v1")))).alias("n_duplicates"),
        F.round(F.avg(size("reactants_canonical")), 6).alias("mean_reactants"),
        F.median(size("reactants_canonical")).alias("median_reactants"),
        F.max(size("products_canonical")).cast("long").alias("max_products"),
        F.min(size("agents_canonical")).cast("long").alias("min_agents"),
        F.count_distinct(F.when(ok, F.col("role_main_substrate"))).alias("n_substrates"),
    )


def usage(good: DataFrame, deduplicated: DataFrame, limit: int = 5) -> DataFrame:
    """The commonest masks before and after deduplication; solvents and main substrates after it."""
    before = profile.usage(good, {"present_mask_before": F.col("present_mask")}, limit)
    after = {
        "present_mask": F.col("present_mask"),
        "solvent": F.col("solvent_normalized"),
        "main_substrate": F.coalesce(p.blank_to_null(F.col("role_main_substrate")), F.lit("unknown")),
    }
    return before.unionByName(profile.usage(deduplicated, after, limit))


def spread(good: DataFrame) -> DataFrame:
    """Sizes of the three sides before deduplication."""
    return profile.spread(good, {c: F.size(f"{c}_canonical") for c in ("reactants", "products", "agents")})
