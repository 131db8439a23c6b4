"""The five phases and the coherence report on small literal rows."""

import hashlib
import json
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from alembiq import jobs
from alembiq.functions import chemistry as chem
from alembiq.functions import hashing, units
from alembiq.functions import parsing as p
from alembiq.operators import bands, canopy, coherence, conditions, fusion, mechanism, normalize, quantiles, structures
from alembiq.plans import queries, reaction_view
from alembiq.shared import cut
from alembiq.sources import files


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("x")).first().x


def ask(spark, f, *values, kind="string"):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}").select(f(F.col("v")).alias("x")).collect()
    return [r.x for r in rows]


R1 = {"rxn_id": "rxn-001", "reactants": "CCO.OCC", "products": "CCOC", "agents": "NaOH", "solvent": "water", "temperature": "25 C", "time": "30 min",
      "pressure": "1 atm", "pH": "7", "phase": "liquid", "light": "dark", "atmosphere": "air", "yield": 0.8, "source": "unit-test", "timestamp": "2024-01-01"}


def frame(spark, *rows):
    names = list(dict.fromkeys(k for r in rows for k in r))
    kinds = {k: next(type(r[k]) for r in rows if r.get(k) is not None) for k in names}
    ddl = {str: "string", float: "double", int: "long", list: "array<string>"}
    return spark.createDataFrame([tuple(r.get(k) for k in names) for r in rows], ", ".join(f"`{k}` {ddl[kinds[k]]}" for k in names))


def test_normalize_gives_hash_and_roles(spark):
    r = normalize.normalize(frame(spark, R1)).first()
    assert r.failures == [] and len(r.reaction_hash_v1) == 64 and r.reactants_canonical == ["CCO", "OCC"]
    assert r.role_main_substrate == "CCO" and r.present_mask == 255
    assert (r.temperature_K, r.time_s, r.pressure_Pa, r.pH) == (298.15, 1800.0, 101325.0, 7.0)


def test_normalize_aliases_and_reaction_string(spark):
    row = {"rxn_id": "rxn-002", "rxn_smiles": "CCO.OCC>>CCOC", "solvents": ["water"], "agents": ["NaOH"], "catalysts": ["Pd/C"], "temperature_c": 25.0,
           "time_min": 45.0, "pressure_atm": 1.0, "ph": 8.0, "phase": "liquid", "atmosphere": "argon"}
    r = normalize.normalize(frame(spark, row)).first()
    assert (r.temperature_K, r.time_s, r.pressure_Pa, r.pH, r.present_mask) == (298.15, 2700.0, 101325.0, 8.0, 239)
    assert r.agents_canonical == ["NaOH", "Pd/C"] and r.solvent_normalized == ["water"] and r.products_canonical == ["CCOC"]


def test_plain_number_is_celsius(spark):
    r = normalize.normalize(frame(spark, {"rxn_id": "a", "reactants": "CCO", "products": "CCOC", "solvent": "ethanol", "temperature": 298.0})).first()
    assert r.temperature_K == 571.15 and r.present_mask == 129 and r.agents_canonical == []


def test_nan_and_blank_are_null(spark):
    row = {"rxn_id": "a", "reactants": "CCO", "products": "C", "temperature": math.nan, "solvent": " ", "yield": math.nan}
    r = normalize.normalize(frame(spark, row)).first()
    assert r.temperature_K is None and r.present_mask == 0 and r["yield"] is None and r.solvent_normalized == [] and r.solvent_confidence == 0


def test_failures(spark):
    table = normalize.normalize(frame(spark, {"rxn_id": "a", "reactants": "A", "products": "A"}, {"rxn_id": "b", "reactants": "A"}, {"rxn_id": "c", "reactants": "A", "products": "B"}))
    good, bad = normalize.split_failures(table)
    assert good.count() == 1 and {r.rxn_id for r in bad.collect()} == {"a", "b"}
    assert normalize.failure_counts(table).collect() == [("missing_reaction_components", 2)]
    assert normalize.summary(table).first().n_ok == 1


def test_columns_that_differ_in_case(spark, tmp_path):
    row = {"rxn_id": "a", "reactants": "CCO", "products": "CCOC", "pH": "7", "ph": 8.0, "temperature_K": 1.0, "temperature_k": 300.0}
    r = normalize.normalize(frame(spark, row, dict(row, rxn_id="b", pH=None))).orderBy("rxn_id").collect()
    assert [(x.pH, x.temperature_K) for x in r] == [(7.0, 300.0), (8.0, 300.0)]
    with files.case_sensitive(spark):
        frame(spark, row).write.parquet(f"{tmp_path}/raw.parquet")
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
    jobs.phase0(spark, f"{tmp_path}/raw.parquet", f"{tmp_path}/rx.parquet", interchange=True)
    got = spark.read.parquet(f"{tmp_path}/rx.parquet").first()
    assert got.pH == 7.0 and got.reactants_canonical == '["CCO"]' and got.provenance == '["a"]'


def test_missing_ids_are_places(spark):
    rows = [{"rxn_id": None if i % 3 else f"r{i}", "reactants": "N" * (i + 1), "products": "C" if i % 5 else None, "o": i} for i in range(20)]
    done, bad = normalize.phase0(frame(spark, *rows).repartition(3), ordinal="o")
    got = {r.reactants_canonical[0]: (r.rxn_id, r.provenance) for r in done.collect()}
    want = {i: f"r{i}" if i % 3 == 0 else str(i) for i in range(20)}
    assert got == {"N" * (i + 1): (want[i], [want[i]]) for i in range(20) if i % 5}
    assert {r.rxn_id for r in bad.collect()} == {want[i] for i in range(0, 20, 5)}
    in_file_order = normalize.normalized_table(frame(spark, *rows).coalesce(1)).collect()
    assert {r.rxn_id for r in in_file_order} == set(want.values())


@pytest.mark.parametrize("suffix", ["csv", "jsonl", "parquet"])
def test_files_are_read_in_order_of_their_names(spark, tmp_path, suffix):
    """Three files of growing size, the largest last, which Spark scans first: the first row of a hash and default ids follow the names."""
    folder, at = tmp_path / f"raw.{suffix}", 0
    folder.mkdir()
    for name, n in (("a", 3), ("b", 40), ("c", 900)):
        rows = pd.DataFrame({"rxn_id": [None if i % 2 else f"{name}{i}" for i in range(n)], "reactants": ["N" * (i % 50 + 1) for i in range(n)], "products": "C", "k": range(at, at + n)})
        at += n
        path = folder / f"{name}.{suffix}"
        {"csv": lambda: rows.to_csv(path, index=False), "jsonl": lambda: rows.to_json(path, orient="records", lines=True), "parquet": lambda: rows.to_parquet(path)}[suffix]()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        read = files.read_ordered(spark, str(folder), "o").select("o", F.col("k").cast("int").alias("k")).collect()
        assert [r.k for r in sorted(read)] == list(range(943)) and len({r.o for r in read}) == 943
        jobs.phase0(spark, str(folder), f"{tmp_path}/rx.parquet")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {len(r.reactants_canonical[0]): (r.rxn_id, r.provenance) for r in spark.read.parquet(f"{tmp_path}/rx.parquet").collect()}
    ids = {k: v for n0, name, n in ((0, "a", 3), (3, "b", 40), (43, "c", 900)) for k, v in ((n0 + i, str(n0 + i) if i % 2 else f"{name}{i}") for i in range(n))}
    lengths = [*range(3), *range(40), *[i % 50 for i in range(900)]]
    want = {m + 1: [ids[k] for k in range(943) if lengths[k] == m] for m in range(50)}
    assert got == {m: (x[0], x) for m, x in want.items()}


PARITY = [
    ("a", "CCO", "25 C", "30 min", "water", "air", 7.0), ("b", "CCO", "1e-7 K", None, None, None, None), ("c", "Cé", "300 K", "2 h", "éther", 'a"b', 1e-07),
    ("d", "N", "1e14 K", "45", "THF; water", "back\\slash", 12.5), ("e", "漢", None, "0.1 s", "😀", "tab\tin", 0.1), ("f", "O", "1e16 K", "1e15 s", "x", "ü", 123456789.125),
    ("g", "S", "0.00001 K", "3 s", "DMF", "A", 3.0), ("h", "P", "-5 C", "7 day", "y", "B/C", 5.684341886080802e-14), ("i", "F", "77 F", "1 h", "z", "q", 1e21), ("j", "I", "20 K", None, "w", None, 100000.0),
]


def test_parity_hashes_are_those_of_python_json(spark):
    """Ten records; text by the standard JSON writer, hash by BLAKE2b."""
    rows = [dict(zip(("rxn_id", "reactants", "temperature", "time", "solvent", "atmosphere", "pH"), r, strict=True), products="C") for r in PARITY]
    made = normalize.normalize(frame(spark, *rows), hash_mode="parity")
    keyed = conditions.condition_keys(made.withColumn("rxn_vid", F.lit(1)), "parity", keep=("rxn_id",))
    keys = {r.rxn_id: r for r in keyed.collect()}
    blake = lambda t: hashlib.blake2b(t.encode(), digest_size=32).hexdigest()
    for r in made.collect():
        side = lambda x: ".".join(x)
        state = {"temperature_K": r.temperature_K, "time_s": r.time_s, "pressure_Pa": r.pressure_Pa, "solvent": r.solvent_normalized, "atmosphere": r.atmosphere, "light": r.light, "phase": r.phase, "pH": r.pH}
        reaction = f"{side(r.reactants_canonical)}>>{side(r.products_canonical)}|{side(r.agents_canonical)}"
        assert r.reaction_hash_v1 == blake(f"{reaction}||{json.dumps(state, sort_keys=True)}")
        k = keys[r.rxn_id]
        solvents = [[x, None] for x in sorted(set(r.solvent_normalized))]
        parts = [solvents, k.temp_K_bin, k.time_s_bin, k.pressure_Pa_bin, k.pH_bin, k.atmosphere, k.light, k.phase, sorted(set(r.agents_canonical)), k.present_mask]
        assert k.cond_hash == blake(json.dumps(parts, sort_keys=True, separators=(",", ":")))
    # by hand: record b, 1e-07 K and no other condition
    text = 'CCO>>C|||{"atmosphere": null, "light": null, "pH": null, "phase": null, "pressure_Pa": null, "solvent": [], "temperature_K": 1e-07, "time_s": null}'
    assert made.filter("rxn_id = 'b'").first().reaction_hash_v1 == blake(text)


def test_condition_keys_tell_quotes_apart(spark):
    rows = [dict(R1, rxn_id="a", atmosphere='x","y', light="z"), dict(R1, rxn_id="b", atmosphere="x", light='y","z')]
    table = normalize.normalize(frame(spark, *rows)).withColumn("rxn_vid", F.lit(1))
    assert conditions.condition_keys(table).select("cond_hash").distinct().count() == 2


def test_unbalanced_molecules_fail(spark):
    rows = [{"rxn_id": "a", "reactants": "C(C", "products": "CC"}, {"rxn_id": "b", "reactants": "C;[Na", "products": "CC;[Na"}, {"rxn_id": "c", "reactants": "C", "products": "O", "agents": "[Pd"}]
    table = normalize.normalize(frame(spark, *rows))
    assert {r.rxn_id: r.failures for r in table.collect()} == {"a": ["molecule_standardization"], "b": [], "c": ["molecule_standardization"]}
    assert [r.warning for r in normalize.warnings(table).collect()] == ["success ratio 0.33 < 0.99"]
    assert normalize.warnings(table.filter("rxn_id = 'b'")).count() == 0 and normalize.warnings(table.limit(0)).count() == 0
    assert normalize.summary(table.limit(0)).first().success_ratio is None


def test_dedup_keeps_first_and_numbers(spark):
    rows = [dict(R1, rxn_id=f"r{i}", reactants="N" * (i % 7 + 1), o=i) for i in range(40)]
    done, bad = normalize.phase0(frame(spark, *rows), ordinal="o")
    got = done.orderBy("rxn_vid").collect()
    assert bad.count() == 0 and [r.rxn_vid for r in got] == list(range(1, 8))
    hashes = [r.reaction_hash_v1 for r in got]
    assert hashes == sorted(hashes)
    assert {tuple(r.provenance) for r in got} == {tuple(f"r{i}" for i in range(k, 40, 7)) for k in range(7)}
    assert all(r.rxn_id == r.provenance[0] for r in got)
    again = normalize.deduplicate(done.drop("rxn_vid"))
    assert again.count() == 7


def test_number_over_many_partitions(spark):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).repartition(7)
    got = normalize.number(df, "k", "n").orderBy("k").collect()
    assert [r.n for r in got] == list(range(1, 1001))
    assert normalize.number(df.limit(0), "k", "n").count() == 0


def test_parsing(spark):
    assert ask(spark, p.split_entities, None, " ", "A;B,C", "A|B", "A, B", "A.B", '["A.B", " ", "C"]', "[Na+].[Cl-]") == [
        [], [], ["A", "B,C"], ["A", "B"], ["A", "B"], ["A", "B"], ["A.B", "C"], ["[Na+]", "[Cl-]"],
    ]
    assert ask(spark, p.tokenize, "N,N-dimethylformamide", "a b", '["x"]', None) == [["N", "N-dimethylformamide"], ["a b"], ["x"], []]
    assert ask(spark, p.ensure_list, "a;b,c", '["a;b"]') == [["a", "b", "c"], ["a;b"]]
    assert ask(spark, p.lenient_ids, "[1, 2]", "3.0;x;4", '["7"]', "-3.5") == [[1, 2], [3, 4], [7], [-3]]
    assert ask(spark, p.to_list, '[" a", "b ", null, ""]', " x ", " ", None) == [[" a", "b ", ""], ["x"], [], []]
    assert ask(spark, p.json_counts, '{"a": 2}', '["x","y","x"]', "z", None) == [{"a": 2}, {"x": 2, "y": 1}, {"z": 1}, None]
    got = ask(spark, p.parse_reaction, "A.B>c>D|e.f", "A>>B", "A>B", "A", "a>b>c>d")
    assert [(r.reactants, r.agents, r.products) for r in got] == [
        (["A", "B"], ["c", "e", "f"], ["D"]), (["A"], [], ["B"]), (["A"], [], ["B"]), ([], [], []), ([], [], []),
    ]
    assert ask(spark, lambda c: p.key_json(F.split(c, ","), pairs=True), "water,ethanol,water") == ['[["ethanol",null],["water",null]]']


def test_units(spark):
    kelvin = lambda c: units.kelvin(*units.value_and_unit(c))
    seconds, pascals = (lambda c, f=f: units.scaled(*units.value_and_unit(c), f) for f in (units.SECONDS, units.PASCALS))
    assert ask(spark, kelvin, "77 °F", "77 F", "rt", "300 K", "25", "20-25 C") == [350.15, pytest.approx(298.15), None, 300.0, 298.15, 293.15]
    assert ask(spark, seconds, "2 h", "1 day", "5 m", "7 foo", None) == [7200.0, 86400.0, 300.0, 7.0, None]
    assert ask(spark, pascals, "1,000 Pa", "1 mPa", "2 bar") == [1.0, 1e6, 2e5]
    assert ask(spark, units.bin_temperature, 298.15, 450.0, 400.0, 405.0, None, kind="double") == ["290-300", "450-475", "400-410", "400-425", None]
    assert ask(spark, units.bin_decade, 1800.0, 101325.0, 1000.0, 0.5, 0.05, 0.0, None, kind="double") == ["1000-10000", "100000-1000000", "1000-10000", "0-1", "0-0", "0-1", None]
    assert ask(spark, units.bin_ph, -1.0, 14.7, 7.2, None, kind="double") == ["0-1", "14-14", "7-8", None]
    assert ask(spark, units.temperature_label, "298.2", "298.5", "299.5", "rt", None) == ["298K", "298K", "300K", "rt", None]


def test_chemistry(spark):
    got = ask(spark, chem.event_family, None, "", "+C:1", "-1:1", "=x:1", "~", "Cl,", "R:CCO", "+-=", "([", "é", "+ :1")
    assert got == ["noop", "noop", "gain:atom_upper", "loss:ring_index", "bond:atom_lower", "bond:other", "neutral:composite", "neutral:atom_upper",
                   "gain:bond_symbol", "neutral:topology", "neutral:atom_lower", "gain:other"]
    got = ask(spark, chem.scaffold_family, None, "Unknown", "A.B", "[Pd]C", "c1ccccc1", "c1ccncc1", "CCC", "CCO", "O", "[H][H]")
    assert got == ["unknown", "unknown", "multi_fragment", "organometallic", "aromatic", "aromatic_hetero", "aliphatic", "aliphatic_hetero", "hetero_only", "inorganic"]
    got = ask(spark, lambda c: chem.resolve_solvent(c, F.when(c == "watr", "water")), "Water", "H2O", "watr", "thf")
    assert [tuple(x) for x in got] == [("water", 1.0), ("water", 0.8), ("water", 0.5), ("thf", 0.1)]
    raw = frame(spark, {"solvent": "watr; thf"}, {"solvent": "Ethanl"}, {"solvent": "thf"}, {"solvent": "water"})
    learnt = normalize.learn_fuzzy(raw)
    assert sorted(map(tuple, learnt.collect())) == [("Ethanl", ["ethanol"]), ("watr; thf", ["water", None])]
    got = normalize.normalize(raw.selectExpr("*", "'A' reactants", "'B' products"), learnt).collect()
    assert sorted((tuple(r.solvent_normalized), r.solvent_confidence) for r in got) == [(("ethanol",), 0.5), (("thf",), 0.1), (("water",), 1.0), (("water", "thf"), 0.3)]
    assert ask(spark, chem.balanced, "C(C)[Na+]", "C(C", "[Na", "CC", "") == [True, False, False, True, True]
    assert ask(spark, chem.molecule_score, "CCO", "c1ccncc1", "aryl") == [3.0, pytest.approx(9.9), 6.0]


N1 = "1L rxn_vid, {mask} present_mask, 298.15D temperature_K, 1800D time_s, 101325D pressure_Pa, 7.2D pH, 'Air' atmosphere, 'Dark' light, 'Liquid' phase, array('water','ethanol') solvent_normalized, array('NaOH') agents_canonical, array('NaCl') spectators_moved, 0.92D resolution_confidence"


def test_condition_keys(spark):
    a, b = (conditions.condition_keys(spark.sql(f"select {N1.format(mask=m)}")).first() for m in (5, 6))
    assert (a.solvent_key, a.catalyst_key, a.agent_key) == ('[["ethanol",null],["water",null]]', '["NaOH"]', '["NaCl"]')
    assert (a.temp_K_bin, a.time_s_bin, a.pressure_Pa_bin, a.pH_bin) == ("290-300", "1000-10000", "100000-1000000", "7-8")
    assert a.cond_hash != b.cond_hash and a.cond_hash.startswith(a.cond_hash_prefix) and len(a.cond_hash_prefix) == 8 and a.light == "dark"


def signatures(spark, *rows):
    """rows: (vid, cond, reactants, products)."""
    keys = spark.createDataFrame([(v, c) for v, c, _, _ in rows], "rxn_vid long, cond_hash string")
    rx = spark.createDataFrame([(v, r, q, r[0]) for v, _, r, q in rows], "rxn_vid long, reactants_canonical array<string>, products_canonical array<string>, role_main_substrate string")
    return mechanism.assign_clusters(mechanism.signatures(keys, rx))


def test_signatures_and_clusters(spark):
    sigs = signatures(spark, (1, "h1", ["CCO"], ["CC=O"]), (2, "h1", ["CCO"], ["CC=O"]), (3, "h2", ["N#N"], ["N#N"]))
    got = {r.rxn_vid: r for r in sigs.collect()}
    assert got[1].signature_type == "mapped" and got[1].event_tokens == ["+=:1"] and got[1].scaffold_key == "CCO"
    assert got[3].signature_type == "unmapped" and got[3].event_tokens == ["R:N#N", "P:N#N"] and got[3].mech_sig_r1 is None
    clusters = sorted(mechanism.level2_clusters(sigs).collect(), key=lambda r: r.rxn_vids)
    assert [r.rxn_vids for r in clusters] == [[1, 2], [3]] and sum(clusters[0].mech_sig_base_counts.values()) == 2
    assert got[1].cluster_id == got[2].cluster_id == clusters[0].cluster_id == "h1-1"
    assert mechanism.summary(sigs).first().n_mapped == 2


def test_same_coarse_key_joins_different_bases(spark):
    sigs = signatures(spark, (10, "c", ["CCO"], ["CCOA"]), (11, "c", ["CCO"], ["CCOB"]))
    (cluster,) = mechanism.level2_clusters(sigs).collect()
    assert cluster.rxn_count == 2 and sorted(cluster.mech_sig_base_counts.values()) == [1, 1] and cluster.rxn_vids == [10, 11]
    first = sigs.filter("rxn_vid = 10").first().mech_sig_base
    assert cluster.mech_sig_base == first


def test_multiset_delta(spark):
    df = spark.createDataFrame([(["CCO", "N"], ["CNO"]), (["A"], ["A"]), ([], ["x x"])], "a array<string>, b array<string>")
    df = df.select(p.characters(F.col("a")).alias("a"), p.characters(F.col("b")).alias("b"))
    assert [r[0] for r in df.select(p.multiset_delta(F.col("a"), F.col("b"))).collect()] == [["-C:1"], [], ["+x:2"]]


def test_percentiles_match_numpy(spark):
    values = [random.Random(1).randrange(100) for _ in range(31)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r.p: r.value for r in mechanism.percentiles(df, "v", (10, 50, 90, 101)).collect()}
    assert got == pytest.approx({q: float(np.percentile(values, q)) for q in (10, 50, 90)})
    assert mechanism.percentiles(df.limit(0), "v").count() == 0


def test_features_resolve_suffixes(spark):
    row = spark.sql("select 1L rxn_vid, 'cid-sfx' CID_lvl2, 'mid-sfx' cluster_id_lvl2, 'ScafX' scaffold_key_sig, array('a') event_tokens_sig, array('b') event_tokens_lvl2, 'base' mech_sig_base_sig, 'no' mech_sig_base_lvl2")
    r = structures.features(row, 512).first()
    assert (r.CID, r.MID, r.scaffold_key) == ("cid-sfx", "mid-sfx", "ScafX")
    assert r.tokens == ["scaffold:ScafX", "mech:base", "event:a"]
    assert structures.features(row.drop("CID_lvl2")).first().CID == "unknown"


def test_expand(spark):
    clusters = spark.createDataFrame([("c", [1, 2]), ("d", [])], "MID string, rxn_vids array<long>")
    assert [(r.MID, r.rxn_vid) for r in structures.expand(clusters).collect()] == [("c", 1), ("c", 2)]
    assert structures.expand(spark.createDataFrame([("c", '["3", "4"]')], "MID string, rxn_vids string")).count() == 2
    with pytest.raises(ValueError):
        structures.expand(clusters.drop("rxn_vids"))


def test_canopies_are_greedy_leaders(spark):
    rng = random.Random(4)
    rows = [(v, f"c{v % 2}", "m", sorted(rng.sample(range(9), rng.randrange(0, 5)))) for v in range(1, 120)]
    df = spark.createDataFrame(rows, "rxn_vid long, CID string, MID string, fingerprint_bits array<int>")
    got = {r.rxn_vid: r.canopy for r in structures.canopies(df, 0.5).collect()}
    for cid in ("c0", "c1"):
        leaders = []
        for v, _, _, bits in (r for r in rows if r[1] == cid):
            b = set(bits)
            sim = [len(b & x) / len(b | x) if b | x else 1.0 for x in leaders]
            want = next((i for i, s in enumerate(sim, 1) if s >= 0.5), None)
            if want is None:
                leaders.append(b)
                want = len(leaders)
            assert got[v] == want
    for block in (7,):
        assert {r.rxn_id: r.canopy for r in canopy.canopies(df.withColumnRenamed("rxn_vid", "rxn_id").withColumn("rxn_vid", F.col("rxn_id")), 0.5, block).collect()} == got
    made = structures.level3_clusters(structures.assign_structures(df.withColumn("scaffold_key", F.lit("s")), 0.5))
    assert made.agg(F.sum("cluster_size")).first()[0] == 119 and made.filter(F.size("exemplar_vids") > 3).count() == 0


def test_canopies_of_one_large_group(spark):
    """200,000 distinct fingerprints of one group: noise around some centres, in rounds of a bounded block."""
    rng = np.random.default_rng(1)
    centres = [np.sort(rng.choice(128, 40, replace=False)) for _ in range(60)]
    picks = rng.integers(0, 60, 200_000)
    drop = rng.integers(0, 40, (200_000, 4))
    lists = [np.delete(centres[c], np.unique(d)).tolist() for c, d in zip(picks.tolist(), drop, strict=True)]
    names = [str(x) for x in lists]
    rows = pd.DataFrame({"rxn_vid": range(200_000), "CID": "c", "MID": "m", "fingerprint_bits": lists})
    got = canopy.canopies(spark.createDataFrame(rows, "rxn_vid long, CID string, MID string, fingerprint_bits array<int>"), 0.6)
    got = got.toPandas().sort_values("rxn_vid")
    assert len(set(names)) > 150_000 and len(got) == 200_000
    # leaders are those of one pass over a bit matrix
    bits = canopy.matrix(lists, 128)
    size, want, n = bits.sum(axis=1), np.zeros(200_000, int), 0
    while (left := np.flatnonzero(want == 0)).size:
        n += 1
        common = bits[left] @ bits[left[0]]
        want[left[common / (size[left] + size[left[0]] - common) >= 0.6]] = n
    assert (got["canopy"].to_numpy() == want).all()


def one_pass(lists, threshold):
    """Canopy numbers of one group, by a bit matrix."""
    bits = canopy.matrix(lists, 128)
    size, want, n = bits.sum(axis=1), np.zeros(len(lists), int), 0
    while (left := np.flatnonzero(want == 0)).size:
        n += 1
        common = bits[left] @ bits[left[0]]
        union = size[left] + size[left[0]] - common
        want[left[np.where(union == 0, 1.0, common / np.maximum(union, 1)) >= threshold]] = n
    return want


@pytest.mark.parametrize(("threshold", "block", "meetings"), [(0.6, 64, 1 << 26), (0.4, 200, 500), (0.0, 64, 1)])
def test_canopies_of_a_sparse_group(spark, threshold, block, meetings, monkeypatch):
    """Sets of very different sizes, most unlike any other, some alike in a row: rounds grow, and shrink where many meet."""
    rng = random.Random(11)
    lists = {tuple(sorted(rng.sample(range(128), rng.choice((0, 1, 2, 3, 5, 8, 12, 12, 12, 20))))) for _ in range(500)}
    base = rng.sample(range(128), 14)
    lists |= {tuple(sorted({*base} - {rng.choice(base), rng.choice(base)} | {rng.randrange(128)})) for _ in range(120)}
    lists = [list(x) for x in sorted(lists, key=lambda x: (len(x) // 7, rng.random()))]
    rows = [(v, "c", "m", bits) for v, bits in enumerate(lists)] + [(v, "d", "m", bits) for v, bits in enumerate(lists[:7])]
    ends = []
    found = canopy._round_end
    monkeypatch.setattr(canopy, "_round_end", lambda *a: ends.append(found(*a)) or ends[-1])
    monkeypatch.setattr(canopy, "MEETINGS", meetings)
    df = spark.createDataFrame(rows, "rxn_vid long, CID string, MID string, fingerprint_bits array<int>")
    got = canopy.canopies(df.repartition(3), threshold, block).toPandas()
    for cid, some in (("c", lists), ("d", lists[:7])):
        own = got[got["CID"] == cid].sort_values("rxn_vid")
        assert own["canopy"].tolist() == one_pass(some, threshold).tolist()
    assert len(ends) <= 4


def test_similar_sets_share_a_band():
    rng = random.Random(2)
    for threshold in (0.3, 0.6, 0.85, 1.0):
        for _ in range(3000):
            a = set(rng.sample(range(20), rng.randrange(0, 14)))
            b = (a | set(rng.sample(range(20), 2))) - set(rng.sample(range(20), rng.randrange(0, 6)))
            if a and b and len(a & b) / len(a | b) >= threshold:
                made = [set(zip(*map(np.ndarray.tolist, bands.bands_of(np.array(sorted(x)), bands.shapes(len(x), list(range(21)), threshold, 4), 8)), strict=True)) for x in (a, b)]
                assert made[0] & made[1]


@pytest.mark.parametrize("block", [3, 2048])
def test_search_is_exact(spark, block):
    rng = random.Random(8)
    rows = [(v, f"c{v % 2}", "m", sorted(rng.sample(range(9), rng.randrange(0, 5)))) for v in range(1, 90)]
    df = spark.createDataFrame(rows, "rxn_vid long, CID string, MID string, fingerprint_bits array<int>")
    got = {(r.query, r.place): (r.rxn_vid, r.similarity) for r in canopy.search(df, F.col("rxn_vid") % 10 == 0, 4, block).collect()}
    want = {}
    for v, cid, _, bits in rows:
        if v % 10 == 0:
            sims = [(-(len(set(bits) & set(b)) / len(set(bits) | set(b)) if bits or b else 1.0), w) for w, c, _, b in rows if c == cid]
            want |= {(v, k): (w, -s) for k, (s, w) in enumerate(sorted(sims)[:4], 1)}
    assert got == want
    assert canopy.search(df.limit(0), F.col("rxn_vid") > 0).count() == 0 and canopy.search(df, F.lit(None).cast("boolean")).count() == 0


def test_index_is_asked(spark, tmp_path):
    """A written index: few candidates, and every answer that of all pairs, by lookup alone or with the blocks."""
    rng = np.random.default_rng(5)
    centres = [rng.choice(128, 14, replace=False) for _ in range(150)]
    lists = [sorted({*rng.choice(c, 12, replace=False).tolist(), int(rng.integers(128))}) for c in centres for _ in range(8)]
    lists += [sorted(rng.choice(128, int(n), replace=False).tolist()) for n in rng.integers(1, 30, 40)]
    rows = [(v, "c", "m", bits) for v, bits in enumerate(lists)]
    df = spark.createDataFrame(rows, "rxn_vid long, CID string, MID string, fingerprint_bits array<int>")
    canopy.build_index(df, 0.5).write.parquet(f"{tmp_path}/index.parquet")
    index = spark.read.parquet(f"{tmp_path}/index.parquet")
    asked = index.filter("first % 10 = 0").select("CID", "MID", "first")
    met = canopy.lookup(index, asked)
    assert met.count() < 0.1 * asked.count() * index.count()
    similar = canopy.similarities(lists, lists)
    sure = sum((similar[v] >= 0.5).sum() >= 5 for v in range(0, len(lists), 10))
    assert 100 < sure < len(lists) / 10  # some queries need the blocks
    got = {(r.query, r.place): (r.rxn_vid, r.similarity) for r in canopy.search(df, F.col("rxn_vid") % 10 == 0, 5, 256, 0.5, index).collect()}
    want = {(v, k): (w, -s) for v in range(0, len(lists), 10) for k, (s, w) in enumerate(sorted(zip(-similar[v], range(len(lists)), strict=True))[:5], 1)}
    assert got == want


def test_quantiles_of_one_large_group(spark):
    """10 million distinct doubles of one group are selected from ranges of a bounded size."""
    df = spark.range(10_000_000).select(F.lit("a").alias("g"), ((F.col("id") * 7_368_787) % 10_000_019 / 7).alias("v"))
    points = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = quantiles.quantiles(df.unionByName(spark.createDataFrame([("b", 3.0), ("b", 4.0), ("c", None)], "g string, v double")), ["g"], "v", points)
    got = {r.g: (r.n, r.q) for r in got.collect()}
    ids = np.arange(10_000_000, dtype=np.int64)
    want = np.quantile((ids * 7_368_787) % 10_000_019 / 7, points)
    assert got["a"][0] == 10_000_000 and np.allclose(got["a"][1], want, rtol=1e-12) and got["b"] == (2, [3.0, 3.1, 3.5, 3.9, 4.0]) and "c" not in got
    parts = quantiles.ranges(df.select("g", F.col("v").alias("x"), F.lit(1).alias("n")).limit(300_000), ["g"], "x", 10)
    assert parts.groupBy("_part").count().agg(F.max("count")).first()[0] < 60_000


@pytest.mark.parametrize("small", [0, 1, 5, 1000])
def test_quantiles_are_those_of_sorted_values(spark, small):
    rng = random.Random(6)
    rows = [(rng.choice("xy"), rng.choice((None, rng.randrange(4), rng.random()))) for _ in range(80)] + [("one", 2.0)]
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows], "g string, v double").repartition(3)
    points = (0.0, 0.33, 0.5, 1.0)
    for group in (["g"], []):
        got = {r["g"] if group else 0: r for r in quantiles.quantiles(df, group, "v", points, small).collect()}
        for key, r in got.items():
            values = [v for g, v in rows if v is not None and (not group or g == key)]
            assert r.n == len(values) and np.allclose(r.q, np.quantile(values, points))
    assert quantiles.quantiles(df.filter("false"), [], "v", points, small).count() == 0


def test_pairs_of_a_hot_id_are_spread(spark):
    """20,000 conditions of one id: 200 million pairs, counted without one task holding the id's."""
    counts = spark.range(20_000).select(F.lit("MID").alias("kind"), F.lit("m").alias("shared_id"), F.concat(F.lit("c"), "id").alias("CID"), F.lit(1).cast("long").alias("n"))
    pairs = fusion.pairs_of(counts.limit(600), 40)
    assert pairs.count() == 600 * 599 // 2 and pairs.select("source", "target").distinct().count() == 600 * 599 // 2
    assert pairs.filter("source >= target").count() == 0
    blocks = counts.select(F.pmod(F.xxhash64("CID"), F.lit(40)).alias("b")).groupBy("b").count()
    assert blocks.agg(F.max("count")).first()[0] < 2 * fusion.BLOCK


def test_tanimoto(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, 2, 4]), ([1], [7]), ([], []), ([], [1])], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(units.tanimoto(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 1.0, 0.0]


def levels(spark):
    l1 = spark.createDataFrame([("C1", [1, 2]), ("C2", [3])], "CID string, rxn_vids array<long>")
    l2 = spark.createDataFrame([("C1", "M1", [1]), ("C1", "M2", [2]), ("C2", "M3", [3])], "CID string, MID string, rxn_vids array<long>")
    l3 = spark.createDataFrame([("C1", "M1", "S1", [1]), ("C1", "M2", "S2", [2]), ("C2", "M3", "S3", [3])], "CID string, MID string, SID string, rxn_vids array<long>")
    return l1, l2, l3


def test_merge_assignments(spark):
    l1, l2, l3 = levels(spark)
    got = sorted(tuple(r) for r in fusion.merge_assignments(l1, l2, l3).collect())
    assert got == [(1, "C1", "M1", "S1"), (2, "C1", "M2", "S2"), (3, "C2", "M3", "S3")]
    long = [x.withColumn("rxn_vid", F.explode("rxn_vids")).drop("rxn_vids") for x in (l1, l2, l3)]
    assert sorted(tuple(r) for r in fusion.merge_assignments(*long).collect()) == got
    with pytest.raises(ValueError, match=r"\[9\]"):
        fusion.merge_assignments(l1, l2.union(spark.createDataFrame([("C9", "M9", [9])], l2.schema)), l3)


def test_cluster_cards(spark):
    assigned = spark.createDataFrame([(1, "C1", "M1", "S1"), (2, "C1", "M1", "S1"), (3, "C2", "M2", "S2")], "rxn_vid long, CID string, MID string, SID string")
    scaffolds = spark.createDataFrame([(1, "ScafA"), (2, "ScafA"), (3, "ScafB")], "rxn_vid long, scaffold_key string")
    mech = spark.createDataFrame([(1, ["tokA", "tokB"], "base1"), (2, ["tokA"], "base1"), (3, ["tokC"], "base2")], "rxn_vid long, event_tokens array<string>, mech_sig_base string")
    rx = spark.createDataFrame([(1, ["water"], 298.2, 0.8), (2, ["water"], 300.5, 0.6), (3, ["ethanol"], 310.0, 0.4)], "rxn_vid long, solvent_normalized array<string>, temperature_K double, `yield` double")
    cards = fusion.cluster_cards(assigned, scaffolds, mech, rx)
    c = cards.filter("SID = 'S1'").first()
    assert c["size"] == 2 and c.dominant_scaffold == "ScafA" and c.top_solvents == [("water", 2)]
    assert c.mechanism_summary[0] == ("base1", 2) and c.mechanism_summary[1] == ("tokA", 2)
    assert [x.value for x in c.top_temperatures] == ["298K", "300K"]
    assert c.yield_mean == pytest.approx(0.7) and c.yield_median == pytest.approx(0.7) and c.yield_count == 2
    assert c.exemplars == ["rxn_1.svg", "rxn_2.svg"]
    final = fusion.clusters_final(assigned, cards).collect()
    assert len(final) == 3 and all('"dominant_scaffold"' in r.cluster_card for r in final)


def test_edges(spark):
    assigned = spark.createDataFrame([(1, "C1", "M1", "S1"), (2, "C2", "M1", "S2"), (3, "C2", "M2", "S2"), (4, "C3", "M1", "S2")], "rxn_vid long, CID string, MID string, SID string")
    got = sorted(tuple(r) for r in fusion.cross_view_edges(assigned).collect())
    assert got == [("MID", "M1", "C1", "C2", 1), ("MID", "M1", "C1", "C3", 1), ("MID", "M1", "C2", "C3", 1), ("SID", "S2", "C2", "C3", 1)]
    assert sorted(map(tuple, fusion.cross_view_classes(assigned).collect())) == [("MID", "M1", 3, 3, 1), ("SID", "S2", 2, 3, 2)]
    lines = fusion.stats_lines(spark.createDataFrame([("C1", 2)], "CID string, size long"), fusion.cross_view_edges(assigned))
    assert lines.groupBy("type").count().count() == 2


def test_top_values(spark):
    df = spark.createDataFrame([("g", v) for v in ["water"] * 3 + ["ethanol"] * 2 + ["methanol", "", None]], "g string, v string")
    assert fusion.top_values(df, ["g"], "v", 2).first().top == [("water", 3), ("ethanol", 2)]


def test_coherence(spark):
    clusters = spark.createDataFrame(
        [("a", 2, {"x": 1, "y": 1}, ("s1", [])), ("b", 3, {"x": 3}, ("s2", [])), ("c", 5, {"x": 4, "y": 1}, ("s1", []))],
        "cluster_id string, rxn_count long, mech_sig_base_counts map<string,long>, coarse_key struct<scaffold:string,families:array<struct<family:string,bucket:string>>>",
    )
    m = coherence.cluster_metrics(clusters)
    got = {r.cluster_id: r for r in m.collect()}
    assert (got["a"].base_entropy, got["a"].top1_base_share, got["a"].base_diversity) == (1.0, 0.5, 2)
    assert (got["b"].base_entropy, got["b"].top1_base_share) == (0.0, 1.0)
    coverage = [x for r in coherence.cumulative_coverage(m).orderBy("x").collect() for x in r]
    assert coverage == pytest.approx([1 / 3, 0.5, 2 / 3, 0.8, 1.0, 1.0])
    sigs = spark.createDataFrame([("a", ["+C:1", "-1:1"], "Mapped"), ("a", ["+N:1"], "unmapped"), (None, ["x"], "mapped")], "cluster_id string, event_tokens array<string>, signature_type string")
    s = coherence.signature_metrics(sigs).first()
    assert (s.event_token_mean, s.mapped_share) == (1.5, 0.5) and s.event_entropy == pytest.approx(0.9182958)
    assert coherence.signature_metrics(sigs.drop("cluster_id")) is None
    both = coherence.enrich(m, coherence.signature_metrics(sigs))
    assert both.count() == 3 and coherence.mapped_share_histogram(both).collect() == [(11, 1)]
    assert coherence.enrich(m, None).filter("mapped_share is null").count() == 3
    assert coherence.correlation(m, "rxn_count", "base_entropy").first().n == 3
    assert coherence.correlation(m.limit(2), "rxn_count", "base_entropy").first().r is None
    assert coherence.entropy_by_scaffold(m).count() == 2 and coherence.entropy_by_scaffold(m.filter("coarse_scaffold = 's1'")).count() == 0
    assert coherence.size_histogram(m).agg(F.sum("n")).first()[0] == 3
    with pytest.raises(ValueError):
        coherence.cluster_metrics(clusters.drop("cluster_id"))


def test_hash_modes(spark):
    import hashlib

    assert ask(spark, hashing.hex_digest, "abc") == [hashlib.sha256(b"abc").hexdigest()]
    assert ask(spark, lambda c: hashing.hex_digest(c, "parity"), "abc", None) == [hashlib.blake2b(b"abc", digest_size=32).hexdigest(), None]
    one_bit = lambda mode: ask(spark, lambda c: hashing.token_bits(F.array(c), 128, mode), "tok")
    assert one_bit("sha2") == [[int(hashlib.sha256(b"tok").hexdigest()[:8], 16) % 128]]
    assert one_bit("parity") == [[int(hashlib.blake2b(b"tok", digest_size=32).hexdigest()[:8], 16) % 128]]


def test_parity_reaches_coarse_keys_and_fingerprints(spark):
    import hashlib

    keys = spark.sql("select 1L rxn_vid, 'c' cond_hash")
    rx = spark.sql("select 1L rxn_vid, array('CCO') reactants_canonical, array('CC=O') products_canonical, 'CCO' role_main_substrate")
    r = mechanism.signatures(keys, rx, "parity").first()
    text = json.dumps({"scaffold": r.coarse_key.scaffold, "families": [list(x) for x in r.coarse_key.families]}, sort_keys=True)
    assert r.coarse_key_hash == hashlib.blake2s(text.encode(), digest_size=16).hexdigest()
    f = structures.features(mechanism.signatures(keys, rx, "parity").withColumnRenamed("cond_hash", "CID"), 64, "parity").first()
    assert f.fingerprint_bits == sorted({int(hashlib.blake2b(t.encode(), digest_size=32).hexdigest()[:8], 16) % 64 for t in f.tokens})


def test_report_of_interchange_files(spark, tmp_path):
    """Counts, coarse keys and tokens as JSON text give the report of the nested columns."""
    keys = spark.createDataFrame([(v, f"c{v % 2}") for v in range(1, 9)], "rxn_vid long, cond_hash string")
    sides = [(v, ["C" * (v % 3 + 1)], ["CO" if v % 4 else "CN"], "CCO") for v in range(1, 9)]
    rx = spark.createDataFrame(sides, "rxn_vid long, reactants_canonical array<string>, products_canonical array<string>, role_main_substrate string")
    sigs = mechanism.assign_clusters(mechanism.signatures(keys, rx))
    clusters = mechanism.level2_clusters(sigs)
    flat = files.interchange(clusters.withColumn("coarse_key", chem.coarse_json(F.col("coarse_key"))))
    assert dict(flat.dtypes)["mech_sig_base_counts"] == dict(flat.dtypes)["coarse_key"] == "string"
    flat.write.parquet(f"{tmp_path}/c.parquet")
    files.interchange(sigs.drop("coarse_key")).write.parquet(f"{tmp_path}/s.parquet")
    jobs.report(spark, f"{tmp_path}/c.parquet", f"{tmp_path}/out", f"{tmp_path}/s.parquet")
    want = coherence.enrich(coherence.cluster_metrics(clusters), coherence.signature_metrics(sigs))
    assert sorted(map(repr, spark.read.parquet(f"{tmp_path}/out/clusters.parquet").collect())) == sorted(map(repr, want.collect()))
    got = ask(spark, p.coarse_key, '{"scaffold": "x", "families": [["b", "one"], ["a", "few"], ["z"]]}', "plain", " ", None, "[1]", "{")
    assert [(r.scaffold, [tuple(x) for x in r.families]) for r in got] == [
        ("x", [("a", "few"), ("b", "one")]), ("plain", []), (None, []), (None, []), (None, []), ("{", []),
    ]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x"], 1)], "id string, xs array<string>, n long")
    files.write_table(df, f"{tmp_path}/t.parquet")
    assert files.read_table(spark, f"{tmp_path}/t.parquet").collect() == df.collect() and (tmp_path / "t.parquet/_SUCCESS").exists()
    (tmp_path / "t.csv").write_text("a,b\n1,\n")
    (tmp_path / "t.json").write_text('[{"a": 1}]')
    (tmp_path / "t.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert files.read_table(spark, f"{tmp_path}/t.csv").first() == ("1", None)
    assert files.read_table(spark, f"{tmp_path}/t.json").count() == 1 and files.read_table(spark, f"{tmp_path}/t.jsonl").count() == 2
    with pytest.raises(ValueError):
        files.read_table(spark, f"{tmp_path}/t.xlsx")
    assert files.interchange(df).first().xs == '["x"]'
    assert not files.write_failures(df.limit(0), f"{tmp_path}/f.parquet") and files.write_failures(df, f"{tmp_path}/f.parquet")
    files.write_jsonl(df, f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").first().value == '{"id":"a","n":1,"xs":["x"]}'
    files.write_table(df.limit(0), f"{tmp_path}/e.parquet")
    assert spark.read.parquet(f"{tmp_path}/e.parquet").columns == df.columns


def exchanges(df) -> list[str]:
    """The exchanges by hash or range in a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hash|range)partitioning\((?!_file)[^)]*\)", plan)


def test_keyed_tables(spark, tmp_path):
    """Tables by buckets: joined without an exchange, overwritten, empty, copied, and with odd names."""
    path = f"{tmp_path}/it's a table.parquet"
    df = spark.range(100).select(F.col("id").alias("rxn_vid"), F.struct(F.col("id").alias("a b")).alias("x y"), F.lit(None).cast("string").alias("Z"))
    for rows, n in ((df, 3), (df.limit(0), 5), (df.filter("rxn_vid < 50"), 4)):
        files.write_keyed(rows, path, "rxn_vid", n)
        back = files.read_table(spark, path)
        assert sorted(back.collect()) == sorted(rows.collect()) and back.columns == df.columns
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not exchanges(files.read_table(spark, path).join(files.read_table(spark, path).select("rxn_vid"), "rxn_vid"))
        assert not exchanges(files.read_ordered(spark, path).groupBy("rxn_vid").agg(F.max_by("Z", "ord")))
        assert exchanges(spark.read.parquet(path).groupBy("rxn_vid").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # a copy carries the metadata on, but its files have no buckets
    spark.read.parquet(path).write.parquet(f"{tmp_path}/copy.parquet")
    assert files.read_table(spark, f"{tmp_path}/copy.parquet").count() == 50
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("alembiq_")]
    files.write_keyed(spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k long, v int"), path, "k")
    assert sorted(r.v for r in files.read_table(spark, path).collect()) == [1, 2, 3]


def test_jobs(spark, tmp_path):
    """The jobs in a row give what the queries give; options come from the parameters."""
    from alembiq.__main__ import main
    from alembiq.plans import queries

    d = "/root/testdata/sf0.001"
    raw = queries.reaction_view(spark, d)
    raw.orderBy("ord").coalesce(1).write.parquet(f"{tmp_path}/raw.parquet")
    at = lambda name: f"{tmp_path}/{name}.parquet"
    main(["phase0", "--input", at("raw"), "--output", at("rx"), "--failed-output", at("bad")])
    main(["phase1", "--input", at("rx"), "--output", at("keys"), "--clusters", at("level1")])
    main(["phase2", "--input", at("rx"), "--cond-table", at("keys"), "--output-dir", str(tmp_path)])
    main(["phase3", "--mechanism-sigs", at("mechanism_sigs"), "--clusters-level2", at("members_level2"), "--output-dir", str(tmp_path)])
    levels = [x for n in (2, 3) for x in (f"--clusters-level{n}", at(f"members_level{n}"))]
    main(
        ["phase4", "--clusters-level1", at("level1"), *levels, "--mechanism-sigs", at("mechanism_sigs"), "--structure-feats", at("structure_feats")]
        + ["--reactions", at("rx"), "--output-dir", str(tmp_path)]
    )
    main(["report", "--clusters", at("clusters_level2"), "--signatures", at("mechanism_sigs"), "--outdir", f"{tmp_path}/report", "--verbose"])
    got = spark.read.parquet(at("clusters_final"))
    assert sorted(got.select("rxn_vid", "CID", "MID", "SID").collect()) == sorted(queries.queries()["merge_assignments"](spark, d).collect())
    assert got.filter("cluster_card is null").count() == 0 and spark.read.parquet(at("bad")).count() > 0
    kinds = {r.type for r in spark.read.json(f"{tmp_path}/cluster_stats.jsonl").select("type").distinct().collect()}
    assert "cluster_card" in kinds and (tmp_path / "clusters_final.parquet/_SUCCESS").exists()
    assert spark.read.json(f"{tmp_path}/indices").count() == spark.read.parquet(at("clusters_level2")).count()
    assert spark.read.parquet(f"{tmp_path}/report/mapped_share_histogram.parquet").count() > 0
    assert not {"rxn_vids"} & {c for n in (2, 3) for c in spark.read.parquet(at(f"clusters_level{n}")).columns}
    # a join of any two tables of a phase has no exchange, but for its ranks of files
    tables = {n: files.read_table(spark, at(n)) for n in ("rx", "keys", "mechanism_sigs", "structure_feats", "assignments", "level1", "members_level2", "members_level3")}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not exchanges(mechanism.signatures(tables["keys"], tables["rx"]))
        assert not exchanges(structures.features(structures.join_levels(structures.expand(tables["members_level2"]), tables["mechanism_sigs"])))
        read = [files.read_ordered(spark, at(n)) for n in ("level1", "members_level2", "members_level3")]
        assert not exchanges(fusion.merge_assignments(*read, check=False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # lists of members, where they are asked for, give the same assignments
    main(["phase1", "--input", at("rx"), "--output", at("keys"), "--clusters", at("listed"), "--arrays"])
    sigs, feats = tables["mechanism_sigs"], tables["structure_feats"]
    listed = spark.read.parquet(at("listed")), mechanism.level2_clusters(sigs).withColumnsRenamed({"cond_hash": "CID", "cluster_id": "MID"}), structures.level3_clusters(feats)
    assert sorted(fusion.merge_assignments(*listed).collect()) == sorted(tables["assignments"].collect())
    short = listed[2].select("CID", "MID", "SID", "exemplar_vids", "cluster_size")
    assert sorted(short.collect()) == sorted(spark.read.parquet(at("clusters_level3")).select(short.columns).collect())
    with pytest.raises(SystemExit):
        main(["phase1", "--input", at("rx")])


def test_usage_and_spread(spark):
    from alembiq.operators import profile

    df = spark.createDataFrame([("a", ["x", "y"], 1), ("b", ["x"], 2), ("b", None, 10), (None, [], None)], "s string, xs array<string>, n int")
    got = {(r.name, r.value): (r.n, r.n_distinct) for r in profile.usage(df, {"s": F.col("s"), "xs": F.col("xs")}, 2).collect()}
    assert got == {("s", "b"): (2, 3), ("s", None): (1, 3), ("xs", "x"): (2, 2), ("xs", "y"): (1, 2)}
    assert profile.spread(df, {"n": F.col("n"), "none": F.lit(None)}).collect() == [("n", 3, 4.333333, 1.0, 10.0, 1.2, 1.5, 2.0, 6.0, 8.4)]
    assert profile.usage(df.limit(0), {"s": F.col("s")}).count() == 0


def test_reports_of_few_rows(spark):
    sigs = spark.createDataFrame([("k1", "c1"), ("k1", "c1"), ("k2", "c1"), ("k2", "c2")], "coarse_text string, cond_hash string")
    assert mechanism.single_condition_keys(sigs).collect() == [("k1", 2)]
    clusters = spark.createDataFrame([("m1", "k", 2), ("m2", "k", 5), ("m0", "k", 5)], "cluster_id string, coarse_text string, rxn_count long")
    assert [r.cluster_id for r in mechanism.largest_clusters(clusters, 2).collect()] == ["m0", "m2"]
    feats = spark.createDataFrame([([1], ["event:a"]), ([1], ["mech:b"]), ([1], ["event:a"])], "fingerprint_bits array<int>, tokens array<string>")
    assert [r.warning for r in structures.warnings(feats).collect()] == ["all fingerprints are equal", "1 reactions have no event"]
    assert structures.warnings(feats.limit(0)).count() == 0


def test_stream_conditions(spark, tmp_path):
    from alembiq.streaming import stream_conditions

    frame(spark, R1, dict(R1, rxn_id="x", reactants="A")).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    q = stream_conditions(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")).writeStream.format("memory").queryName("keys").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("keys").count() == 2


def test_entry_contract(spark):
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) > 40
    assert e.entry(spark).count() == 10


def test_stats_jsonl_reads_whole_lines(spark):
    made = queries.queries()["stats_jsonl"](spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in plan.splitlines() if "StructsToJson" in x)
    assert all(c in line for c in ("mechanism_summary", "top_solvents", "shared_id", "source"))
    assert [(r.type, r.n > 0) for r in made.collect()] == [("cluster_card", True)]


def planned(df, which="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def test_places_are_joined_without_a_broadcast(spark):
    """Both sides of the join have a row for every row of the input."""
    plan = planned(queries.file_order_ids(spark, "/root/testdata/sf0.001"), "executedPlan")
    assert "SortMergeJoin [ord" in plan or "SortMergeJoin [place" in plan


def test_spectators_are_found_once(spark):
    raw = frame(spark, {"rxn_id": "a", "reactants": "N a;C\tl;B;B", "products": '["B", "C l", "", "O"]', "agents": " K , J"}, {"rxn_id": "b", "reactants": "C", "products": None, "agents": " . "})
    made = normalize.normalize(raw)
    assert planned(made).count("array_intersect(") == 1
    a, b = made.orderBy("rxn_id").collect()
    assert (a.reactants_canonical, a.products_canonical, a.agents_canonical, a.spectators_moved) == (["Na"], ["O"], ["B", "Cl", "J", "K"], ["B", "Cl"])
    assert (b.reactants_canonical, b.products_canonical, b.agents_canonical) == (["C"], [], []) and b.failures == ["missing_reaction_components"]


def test_texts_are_compared_after_distinct(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(normalize, "cut", lambda df, name: made.setdefault(name, cut(df, name)))
    assert normalize.learn_fuzzy(frame(spark, *[{"solvent": "watr"}] * 50)).count() == 1 and made["solvents"].count() == 1


def test_unbalanced_molecules_are_made_once(spark):
    assert "array_intersect(" not in planned(queries.unbalanced_molecules(spark, "/root/testdata/sf0.001"))


def test_blanks_around_separators(spark):
    far = "a" + " " * 200_000 + "b"
    assert ask(spark, p.tokenize, "a ; ;\tb c\n;", f"{far};c", "; ;", far, None) == [["a", "b c"], [far, "c"], [], [far], []]
    assert ask(spark, p.split_entities, "a . b..c", " ., ", f"{far}.c") == [["a", "b", "c"], ["."], [far, "c"]]


def test_equal_rows_are_normalized_once(spark, monkeypatch):
    """The reactions are those of all rows, though rows with equal texts are one row of the normalize step."""
    kinds = [R1, {**R1, "pH": "3", "reactants": " CCO.OCC "}, {**R1, "reactants": "OCC;CCO"}, {**R1, "products": None}, {**R1, "temperature": float("nan")}]
    rows = [{**r, "temperature": None if r["temperature"] != "25 C" else "25 C", "temp_k": -0.0 if i % 2 else 0.0, "o": (i * 37) % 101, "rxn_id": str(i), "yield": float(i)} for i, r in enumerate(kinds * 20)]
    raw = frame(spark, *rows)
    raw = raw.select("*", F.when(F.col("o") % 2 == 0, "9").alias("ph")).repartition(4)
    made, every = {}, ["rxn_vid", "reaction_hash_v1", "ord", "reactants_canonical", "agents_canonical", "pH", "temperature_K", "present_mask", "solvent_normalized", "yield"]
    whole = normalize.phase0(raw, ordinal="o")[0].select(*every).orderBy("rxn_vid").collect()
    monkeypatch.setattr(normalize, "cut", lambda df, name: made.setdefault(name, cut(df, name)))
    assert normalize.reactions(raw, ordinal="o", keep=("yield",)).select(*every).orderBy("rxn_vid").collect() == whole
    assert made["normalized"].count() == made["distinct-rows"].count() < 25 and "rxn_id" not in made["normalized"].columns
    assert sum(r["failures"] != [] for r in made["normalized"].collect()) > 0
    monkeypatch.undo()
    assert normalize.reactions(frame(spark, R1).limit(0)).isEmpty() and normalize.reactions(frame(spark, {"rxn_id": "a"}, {"rxn_id": "b"})).isEmpty()


def test_condition_keys_normalize_distinct_rows(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(normalize, "cut", lambda df, name: made.setdefault(name, cut(df, name)))
    d = "/root/testdata/sf0.01"
    queries.queries()["condition_keys"](spark, d)
    assert made["normalized"].count() < queries.reaction_view(spark, d).count()


def test_lines_are_sorted_once(spark):
    """They are dealt by order before they are grouped, so that nothing is sorted to be combined on the other side of the exchange."""
    plan = planned(queries.reaction_view(spark, "/root/testdata/sf0.001"), "executedPlan").splitlines()
    dealt = next(i for i, x in enumerate(plan) if "Exchange hashpartitioning(l_orderkey" in x)
    assert any("Aggregate" in x for x in plan[:dealt]) and not any("Aggregate" in x for x in plan[dealt:])


def test_words_of_parts_are_cut_before_lines_meet_them(spark):
    plan = planned(queries.reaction_view(spark, "/root/testdata/sf0.001")).splitlines()
    met = next(i for i, x in enumerate(plan) if "Join Inner, (l_partkey" in x)
    cut_at = [i for i, x in enumerate(plan) if "p_name" in x and "split" in x.lower()]
    assert cut_at and min(cut_at) > met


def test_rows_are_made_distinct_before_texts_are_trimmed(spark, monkeypatch):
    """One key, of the texts as they are; rows that differ in blanks are one reaction all the same."""
    rows = [{**R1, "o": i, "rxn_id": str(i), "solvent": "water" + " " * (i % 3), "temperature": [25.0, float("nan"), -0.0][i % 3]} for i in range(30)]
    raw, plans, every = frame(spark, *rows), {}, ["rxn_vid", "reaction_hash_v1", "ord", "temperature_K", "solvent_normalized", "yield"]
    whole = normalize.phase0(raw, ordinal="o")[0].select(*every).orderBy("rxn_vid").collect()
    monkeypatch.setattr(normalize, "cut", lambda df, name: plans.setdefault(name, planned(df)) and cut(df, name))
    assert normalize.reactions(raw, ordinal="o", keep=("yield",)).select(*every).orderBy("rxn_vid").collect() == whole and len(whole) == 3
    by = next(x for x in plans["distinct-rows"].splitlines() if "Aggregate [" in x)
    assert re.search(r"Aggregate \[texts#\d+\]", by) and "trim(reactants" not in plans["distinct-rows"] and plans["distinct-rows"].count("trim(") <= 2


def test_equal_sides_are_signed_once(spark, monkeypatch):
    made = {}
    kinds = [(["CCO"], ["CC=O"], "CCO"), (["N", "O"], ["ON"], "N"), (["N", "O"], ["ON"], None), (["NO"], ["ON"], "NO"), ([], [], None)]
    rows = [(i, f"h{i % 3}", *kinds[i % len(kinds)]) for i in range(60)]
    keyed = spark.createDataFrame(rows, "rxn_vid long, cond_hash string, reactants_canonical array<string>, products_canonical array<string>, role_main_substrate string")
    want = mechanism.signatures(keyed.select("rxn_vid", "cond_hash"), keyed)
    monkeypatch.setattr(mechanism, "cut", lambda df, name: made.setdefault(name, cut(df, name)))
    got = mechanism.distinct_signatures(keyed)
    assert got.dtypes == want.dtypes and got.orderBy("rxn_vid").collect() == want.orderBy("rxn_vid").collect() and want.count() == 60
    assert made["signed"].count() == len(kinds)
    made.clear()
    queries.sigs(spark, "/root/testdata/sf0.01")
    assert made["signed"].count() < made["signatures"].count()


def test_families_are_found_once_a_token(spark, monkeypatch):
    made = {}
    sigs = spark.createDataFrame([(f"c{i % 3}", ["+C:1", "-o:2", None][: i % 4] + ["+N:1"] * 2) for i in range(40)] + [("none", []), (None, ["+Q:1"])], "cluster_id string, event_tokens array<string>")
    monkeypatch.setattr(coherence, "cut", lambda df, name: made.setdefault(name, cut(df, name)))
    got = {r.cluster_id: r for r in coherence.signature_metrics(sigs).collect()}
    assert made["families"].count() == 4 and set(got) == {"c0", "c1", "c2", "none"} and got["none"].event_entropy == 0
    tokens = [x for i in range(40) if i % 3 == 1 for x in ["+C:1", "-o:2", None][: i % 4] + ["+N:1"] * 2]
    kinds = [sum(x in ("+C:1", "+N:1") for x in tokens), tokens.count("-o:2"), tokens.count(None)]
    assert got["c1"].event_entropy == pytest.approx(-sum(n / len(tokens) * math.log2(n / len(tokens)) for n in kinds))


def order_tables(spark, path, states):
    """Orders, lines and parts with null and long texts; lines without a part; orders without lines."""
    parts = [(i, None if i % 7 == 6 else f"{'hot red big'.split()[i % 3]} x", ["LARGE", "a b", None][i % 3]) for i in range(20)]
    lines = [(i % 60, i % 23 if i % 4 else None, i % 5 + 1, float(i % 60), (i % 11) / 100, states[(i * 7) % len(states)]) for i in range(400)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string").write.parquet(f"{path}/part.parquet")
    kinds = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, l_linestatus string"
    spark.createDataFrame(lines, kinds).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(i, i * 5 % 13) for i in range(5, 70)], "o_orderkey long, o_custkey long").write.parquet(f"{path}/orders.parquet")
    return str(path)


@pytest.mark.parametrize("bound", [1 << 21, 0])
@pytest.mark.parametrize("states", [["O", "F", None], ["open", "o", "", "\u00e9", None, "opened", "Z"]])
def test_distinct_view_has_the_first_rows(spark, tmp_path, monkeypatch, states, bound):
    monkeypatch.setattr(reaction_view, "BROADCAST_ROWS", bound)
    d = order_tables(spark, tmp_path, states)
    whole, some = queries.reaction_view(spark, d), queries.distinct_view(spark, d)
    texts = [c for c in whole.columns if c not in ("ord", "rxn_id", "yield")]
    first = lambda df: df.groupBy(*texts).agg(F.min("ord").alias("ord"), F.min_by("yield", "ord").alias("yield"), F.min_by("rxn_id", "ord").alias("rxn_id"))
    assert whole.dtypes == some.dtypes and whole.count() > 20
    assert first(whole).exceptAll(first(some)).isEmpty() and first(some).exceptAll(first(whole)).isEmpty()
    assert some.exceptAll(whole).isEmpty()


def test_lines_are_grouped_by_hashing(spark, monkeypatch):
    """Nothing of the lines is sorted: the distinct rows of the queries have no sort by part or line, and parts no broadcast beyond the bound."""
    plans = {}
    monkeypatch.setattr(normalize, "cut", lambda df, name: plans.setdefault(name, planned(df, "executedPlan")) and cut(df, name))
    monkeypatch.setattr(reaction_view, "BROADCAST_ROWS", 0)
    queries.reactions(spark, "/root/testdata/sf0.001")
    plan = plans["distinct-rows"]
    assert re.search(r"HashAggregate\(keys=\[l_orderkey", plan) and "SortAggregate(keys=[l_orderkey" not in plan
    assert "ShuffledHashJoin [l_partkey" in plan and not re.search(r"Sort \[l_partkey", plan)


def test_signatures_are_not_broadcast(spark):
    kinds = "rxn_vid long, cond_hash string, coarse_text string"
    sigs = spark.createDataFrame([(i, f"h{i % 3}", f"t{i % 5}") for i in range(60)], kinds)
    found = mechanism.assign_clusters(sigs)
    assert "Broadcast" not in planned(found, "executedPlan")
    assert {(r.cond_hash, r.coarse_text, r.cluster_id) for r in found.collect()} == {(f"h{i}", f"t{j}", f"h{i}-{j + 1}") for i in range(3) for j in range(5)}
