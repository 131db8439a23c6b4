"""DuckDB SQL of each query, as chains of common table expressions."""

from __future__ import annotations

from .reaction_view import RAW

NUM = r"'^([-+]?\d*\.?\d+)'"
UNIT = r"'^[-+]?\d*\.?\d+\s*([A-Za-z°%]+)'"
BARE = r"lambda x: regexp_replace(x, '\s+', '', 'g')"

PARTS = f"""
parts AS (SELECT *,
  coalesce(list_transform(CASE WHEN reactants IS NOT NULL OR products IS NOT NULL THEN string_split(reactants, ';') ELSE string_split(string_split(rxn_smiles, '>')[1], '.') END, lambda x: trim(x)), []) AS r0,
  coalesce(list_transform(CASE WHEN reactants IS NOT NULL OR products IS NOT NULL THEN string_split(products, ';') ELSE string_split(split_part(string_split(rxn_smiles, '>')[3], '|', 1), '.') END, lambda x: trim(x)), []) AS p0,
  list_concat([agents], CASE WHEN rxn_smiles IS NOT NULL THEN ['NaOH', 'K OH'] ELSE [] END) AS a0 FROM raw),
bare AS (SELECT *, list_transform(r0, {BARE}) AS r1, list_transform(p0, {BARE}) AS p1, list_transform(a0, {BARE}) AS a1 FROM parts),
spect AS (SELECT *, list_sort(list_distinct(list_filter(r1, lambda x: list_contains(p1, x)))) AS sp FROM bare),
sides AS (SELECT *, list_sort(list_filter(r1, lambda x: NOT list_contains(sp, x))) AS r, list_sort(list_filter(p1, lambda x: NOT list_contains(sp, x))) AS p,
  list_sort(list_concat(a1, sp)) AS a FROM spect)"""

CONDITIONS = f"""
cond AS (SELECT *,
  CASE WHEN temperature_k IS NOT NULL AND temperature IS NULL THEN temperature_k
       WHEN lower(regexp_extract(temperature, {UNIT}, 1)) = 'f' THEN (TRY_CAST(regexp_extract(temperature, {NUM}, 1) AS DOUBLE) - 32) * 5.0::DOUBLE / 9.0::DOUBLE + 273.15::DOUBLE
       ELSE TRY_CAST(nullif(regexp_extract(temperature, {NUM}, 1), '') AS DOUBLE) + 273.15::DOUBLE END AS tk,
  TRY_CAST(regexp_extract(time, {NUM}, 1) AS DOUBLE) * CASE regexp_extract(time, {UNIT}, 1) WHEN 'min' THEN 60 WHEN 'h' THEN 3600 ELSE 1 END AS ts,
  pressure_atm * 101325.0::DOUBLE AS pp, TRY_CAST(ph AS DOUBLE) AS ph_n, trim(atmosphere) AS atmo, nullif(trim(irradiation), '') AS lig,
  CASE solvent WHEN 'water' THEN ['water'] WHEN 'H2O' THEN ['water'] WHEN 'EtOH; MeCN' THEN ['ethanol', 'acetonitrile'] WHEN 'watr' THEN ['water'] WHEN 'THF' THEN ['thf'] ELSE [] END AS sol,
  CASE solvent WHEN 'water' THEN 1.0 WHEN 'H2O' THEN 0.8 WHEN 'EtOH; MeCN' THEN 0.8 WHEN 'watr' THEN 0.5 WHEN 'THF' THEN 0.1 ELSE 0.0 END::DOUBLE AS conf,
  (temperature IS NOT NULL OR temperature_k IS NOT NULL)::INT + 2 * (time IS NOT NULL)::INT + 4 * (pressure_atm IS NOT NULL)::INT + 8 * (trim(atmosphere) <> '')::INT
   + 16 * (trim(irradiation) <> '')::INT + 32 * (ph IS NOT NULL)::INT + 64 * (phase IS NOT NULL)::INT + 128 * (solvent IS NOT NULL)::INT AS mask FROM sides),
norm AS (SELECT *, len(r) = 0 OR len(p) = 0 AS failed, sha256(array_to_string(r, '.') || '>>' || array_to_string(p, '.') || '|' || array_to_string(a, '.') || '||'
  || '{{"atmosphere":"' || atmo || '","light":' || coalesce('"' || lig || '"', 'null') || ',"pH":' || coalesce(ph_n::VARCHAR, 'null') || ',"phase":"' || phase || '","pressure_Pa":' || coalesce(pp::VARCHAR, 'null')
  || ',"solvent":[' || coalesce(array_to_string(list_transform(sol, lambda x: '"' || x || '"'), ','), '') || '],"temperature_K":' || coalesce(tk::VARCHAR, 'null') || ',"time_s":' || ts::VARCHAR || '}}') AS h FROM cond),
good AS (SELECT * FROM norm WHERE NOT failed),
score AS (SELECT ord, m, i, length(m) + CASE WHEN lower(m) LIKE '%ar%' OR m LIKE '%c1%' THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END - (length(m) - length(replace(lower(m), 'n', ''))) * 0.1::DOUBLE AS s
  FROM (SELECT ord, unnest(r) AS m, unnest(range(len(r))) AS i FROM good)),
main AS (SELECT ord, arg_min(m, (-s, i)) AS main FROM score GROUP BY ord),
firsts AS (SELECT h, min(ord) AS ord, string_agg(rxn_id, ',' ORDER BY ord) AS provenance, count(*) AS copies FROM good GROUP BY h),
rx AS (SELECT row_number() OVER (ORDER BY f.h) AS rxn_vid, g.*, main.main, f.provenance FROM firsts f JOIN good g ON f.ord = g.ord JOIN main ON main.ord = g.ord)"""

KEYS = """
bins AS (SELECT *,
  CASE WHEN tk <= 400 THEN (floor(tk / 10) * 10)::BIGINT || '-' || (floor(tk / 10) * 10 + 10)::BIGINT ELSE (floor((tk - 400) / 25) * 25 + 400)::BIGINT || '-' || (floor((tk - 400) / 25) * 25 + 425)::BIGINT END AS tb,
  (10 ** floor(log10(ts)))::BIGINT || '-' || (10 ** (floor(log10(ts)) + 1))::BIGINT AS sb,
  (10 ** floor(log10(pp)))::BIGINT || '-' || (10 ** (floor(log10(pp)) + 1))::BIGINT AS pb,
  CASE WHEN ph_n IS NOT NULL THEN floor(least(14, greatest(0, ph_n)))::BIGINT || '-' || least(14, floor(least(14, greatest(0, ph_n))) + 1)::BIGINT END AS hb,
  '[' || coalesce(array_to_string(list_transform(list_sort(list_distinct(sol)), lambda x: '["' || x || '",null]'), ','), '') || ']' AS sk,
  '[' || coalesce(array_to_string(list_transform(list_sort(list_distinct(a)), lambda x: '"' || x || '"'), ','), '') || ']' AS ck,
  '[' || coalesce(array_to_string(list_transform(list_sort(list_distinct(sp)), lambda x: '"' || x || '"'), ','), '') || ']' AS ak FROM rx),
keys AS (SELECT *, sha256('[' || sk || ',' || coalesce('"' || tb || '"', 'null') || ',' || coalesce('"' || sb || '"', 'null') || ',' || coalesce('"' || pb || '"', 'null') || ',' || coalesce('"' || hb || '"', 'null')
  || ',"' || lower(atmo) || '",' || coalesce('"' || lower(lig) || '"', 'null') || ',"' || lower(phase) || '",' || ck || ',' || mask || ']') AS cid FROM bins)"""

SIGS = r"""
chars AS (SELECT *, regexp_extract_all(array_to_string(r, ''), '\S') AS ca, regexp_extract_all(array_to_string(p, ''), '\S') AS cb FROM keys),
deltas AS (SELECT *, list_transform(list_sort(list_distinct(list_concat(ca, cb))), lambda c: {'c': c, 'n': len(list_filter(cb, lambda y: y = c)) - len(list_filter(ca, lambda y: y = c))}) AS d FROM chars),
events AS (SELECT *, list_concat(list_transform(list_filter(d, lambda x: x.n > 0), lambda x: '+' || x.c || ':' || x.n), list_transform(list_filter(d, lambda x: x.n < 0), lambda x: '-' || x.c || ':' || (-x.n))) AS ev FROM deltas),
toks AS (SELECT *, CASE WHEN len(ev) > 0 THEN 'mapped' ELSE 'unmapped' END AS kind,
  CASE WHEN len(ev) > 0 THEN ev ELSE list_concat(list_sort(list_transform(r, lambda x: 'R:' || x)), list_sort(list_transform(p, lambda x: 'P:' || x))) END AS tok FROM events),
sig0 AS (SELECT *, sha256(CASE WHEN kind = 'mapped' THEN 'base|' ELSE '' END || array_to_string(tok, '|')) AS base,
  CASE WHEN main LIKE '%.%' THEN 'multi_fragment' WHEN main LIKE '[Pd]%' THEN 'organometallic'
   WHEN regexp_matches(lower(main), 'c[1-9]') THEN CASE WHEN regexp_matches(lower(main), '[nosp]') THEN 'aromatic_hetero' ELSE 'aromatic' END
   WHEN main LIKE '%C%' THEN CASE WHEN regexp_matches(main, '[NOSPFI]|Cl|Br') OR regexp_matches(lower(main), '[nosp]') THEN 'aliphatic_hetero' ELSE 'aliphatic' END
   WHEN regexp_matches(main, '[NOSPFI]|Cl|Br') OR regexp_matches(lower(main), '[nosp]') THEN 'hetero_only' ELSE 'inorganic' END AS fam FROM toks),
ft AS (SELECT rxn_vid, t, trim(split_part(t, ':', 1)) AS b FROM (SELECT rxn_vid, unnest(tok) AS t FROM sig0)),
fr AS (SELECT *, CASE b[1] WHEN '+' THEN 'gain' WHEN '-' THEN 'loss' WHEN '=' THEN 'bond' WHEN '#' THEN 'bond' WHEN '~' THEN 'bond' ELSE 'neutral' END AS pol,
  CASE WHEN b[1] IN ('+', '-', '=', '#', '~') THEN b[2:] ELSE b END AS rest FROM ft),
ff AS (SELECT rxn_vid, pol || ':' || CASE WHEN rest = '' THEN 'other' WHEN rest LIKE '%,%' THEN 'composite' WHEN regexp_matches(rest, '[0-9]') THEN 'ring_index'
  WHEN regexp_full_match(rest, '[A-Z]+') THEN 'atom_upper' WHEN regexp_full_match(rest, '[a-z]+') THEN 'atom_lower' WHEN regexp_full_match(rest, '[A-Za-z]+') THEN 'atom_mixed'
  WHEN regexp_full_match(rest, '[-=#]+') THEN 'bond_symbol' WHEN regexp_full_match(rest, '[()\[\]{}]+') THEN 'topology' ELSE 'other' END AS f FROM fr),
fc AS (SELECT rxn_vid, f, count(*) AS n FROM ff GROUP BY rxn_vid, f),
fk AS (SELECT rxn_vid, string_agg(f || ':' || CASE WHEN n <= 1 THEN 'one' WHEN n <= 4 THEN 'few' ELSE 'many' END, ',' ORDER BY f) AS fams FROM fc GROUP BY rxn_vid),
sig AS (SELECT *, fam || '|' || fams AS coarse, cid || '-' || dense_rank() OVER (PARTITION BY cid ORDER BY fam || '|' || fams) AS mid FROM sig0 JOIN fk USING (rxn_vid)),
cb AS (SELECT cid, mid, coarse, base, count(*) AS n, min(rxn_vid) AS first FROM sig GROUP BY cid, mid, coarse, base),
c2 AS (SELECT cid, mid, coarse, sum(n)::BIGINT AS size, count(*) AS diversity, arg_max(base, (n, -first)) AS top, max(n)::DOUBLE / sum(n) AS share,
  -sum(n / total * log2(n / total)) AS ent FROM (SELECT *, (sum(n) OVER (PARTITION BY mid))::DOUBLE AS total FROM cb) GROUP BY cid, mid, coarse)"""

FEATS = """
fb AS (SELECT DISTINCT rxn_vid, (('0x' || sha256(t)[1:8])::UBIGINT % 128)::INT AS bit FROM
  (SELECT rxn_vid, unnest(list_concat(['scaffold:' || main, 'mech:' || base], list_transform(tok, lambda x: 'event:' || x))) AS t FROM sig)),
feat AS (SELECT rxn_vid, cid, mid, main, bits FROM sig JOIN (SELECT rxn_vid, list(bit ORDER BY bit) AS bits FROM fb GROUP BY rxn_vid) USING (rxn_vid))"""

CANOPY = """
di AS (SELECT cid, mid, bits, row_number() OVER (PARTITION BY cid, mid ORDER BY min(rxn_vid)) AS pos FROM feat GROUP BY cid, mid, bits),
fold AS (SELECT cid, mid, pos, bits, [bits] AS leaders, 1 AS idx FROM di WHERE pos = 1 UNION ALL
  SELECT cid, mid, pos, bits, CASE WHEN m IS NULL THEN list_append(leaders, bits) ELSE leaders END, coalesce(m, len(leaders) + 1)::INT FROM
   (SELECT d.cid, d.mid, d.pos, d.bits, f.leaders, nullif(list_position(list_transform(f.leaders, lambda l: len(list_intersect(l, d.bits))::DOUBLE / (len(l) + len(d.bits) - len(list_intersect(l, d.bits))) >= 0.6), true), 0) AS m
    FROM fold f JOIN di d ON d.mid = f.mid AND d.cid = f.cid AND d.pos = f.pos + 1)),
sids AS (SELECT feat.*, mid || '-S' || idx AS sid FROM feat JOIN fold USING (cid, mid, bits))"""

CHAIN = [("raw", RAW), ("parts", PARTS), ("norm", CONDITIONS), ("keys", KEYS), ("sig", SIGS), ("feat", FEATS), ("sids", CANOPY)]


def chain(upto: str, select: str, more: str = "") -> str:
    """WITH all expressions up to one, then a select; ``more`` adds expressions."""
    parts = []
    for name, text in CHAIN:
        parts.append(text.strip())
        if name == upto:
            break
    if more:
        parts.append(more.strip())
    return f"WITH RECURSIVE {','.join(parts)} {select}"


CARD = """
cw AS (SELECT cid, mid, sid, coalesce(sol[1], '') AS sol, CASE WHEN tk IS NOT NULL THEN round_even(tk, 0)::BIGINT || 'K' END AS temp, yield_share, main, tok, base, rxn_vid FROM sids JOIN (SELECT rxn_vid, sol, tk, yield_share, tok, base FROM sig) USING (rxn_vid)),
vals AS (SELECT sid, 'solvent' AS what, sol AS v, 3 AS k FROM cw UNION ALL SELECT sid, 'temperature', temp, 3 FROM cw UNION ALL SELECT sid, 'scaffold', main, 1 FROM cw
  UNION ALL SELECT sid, 'token', unnest(list_append(tok, base)), 5 FROM cw),
tops AS (SELECT sid, what, string_agg(v || '=' || n, ';' ORDER BY n DESC, v) AS t FROM (SELECT sid, what, v, k, count(*) AS n, row_number() OVER (PARTITION BY sid, what ORDER BY count(*) DESC, v) AS pl
  FROM vals WHERE v <> '' GROUP BY sid, what, v, k) WHERE pl <= k GROUP BY sid, what),
cards AS (SELECT cid AS "CID", mid AS "MID", sid AS "SID", count(*) AS size, max(t1.t) AS top_solvents, max(t2.t) AS top_temperatures, max(split_part(t3.t, '=', 1)) AS dominant_scaffold,
  max(t4.t) AS mechanism_summary, round(avg(yield_share), 6) AS yield_mean, round(median(yield_share), 6) AS yield_median, count(yield_share) AS yield_count,
  array_to_string(list_transform(list(cw.rxn_vid ORDER BY cw.rxn_vid)[1:5], lambda v: 'rxn_' || v || '.svg'), ',') AS exemplars FROM cw LEFT JOIN (FROM tops WHERE what = 'solvent') t1 USING (sid) LEFT JOIN (FROM tops WHERE what = 'temperature') t2 USING (sid)
  LEFT JOIN (FROM tops WHERE what = 'scaffold') t3 USING (sid) LEFT JOIN (FROM tops WHERE what = 'token') t4 USING (sid) GROUP BY cid, mid, sid)"""
ENTROPY = """
sf AS (SELECT mid, f, count(*) AS n FROM (SELECT sig.mid, replace(ff.f, 'composite', 'other') AS f FROM ff JOIN sig USING (rxn_vid)) GROUP BY mid, f),
se AS (SELECT mid, -sum(n / total * log2(n / total)) AS event_entropy FROM (SELECT *, (sum(n) OVER (PARTITION BY mid))::DOUBLE AS total FROM sf) GROUP BY mid),
sm AS (SELECT mid, avg(len(tok)) AS event_token_mean, avg((kind = 'mapped')::INT) AS mapped_share, event_entropy FROM sig JOIN se USING (mid) GROUP BY mid, event_entropy)"""
EDGES = """
ab AS (SELECT DISTINCT l_orderkey, l_linenumber, p_brand AS "CID", split_part(p_type, ' ', 1) AS "MID", p_size % 5 AS s FROM lineitem JOIN part ON l_partkey = p_partkey),
ac AS (SELECT 'MID' AS kind, "MID" AS shared_id, "CID", count(*) AS n FROM ab GROUP BY 2, 3 UNION ALL SELECT 'SID', 'S' || s, "CID", count(*) FROM ab GROUP BY 2, 3)"""

TOKENS = """
fx AS (SELECT *, list_distinct(list_concat(['scaffold:' || main, 'mech:' || base], list_transform(tok, lambda x: 'event:' || x))) AS tks FROM sig)"""


def usage(*parts: tuple[str, str, str], limit: int = 5) -> str:
    """The commonest values; each part is (name, value, table)."""
    rows = " UNION ALL ".join(f"SELECT '{name}' AS name, ({value})::VARCHAR AS value FROM {table}" for name, value, table in parts)
    order = "row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, value NULLS FIRST)"
    return f"SELECT name, value, n, n_distinct FROM (SELECT name, value, count(*) AS n, count(*) OVER (PARTITION BY name) AS n_distinct, {order} AS pl FROM ({rows}) GROUP BY name, value) WHERE pl <= {limit}"


def spread(*parts: tuple[str, str, str]) -> str:
    """Moments and percentiles; each part is (name, value, table)."""
    rows = " UNION ALL ".join(f"SELECT '{name}' AS name, ({value})::DOUBLE AS v FROM {table}" for name, value, table in parts)
    points = ", ".join(f"round(quantile_cont(v, {p} / 100), 6) AS p{p}" for p in (10, 25, 50, 75, 90))
    return f"SELECT name, count(v) AS n, round(avg(v), 6) AS mean, min(v) AS low, max(v) AS high, {points} FROM ({rows}) GROUP BY name"


ORACLE: dict[str, str] = {
    "reaction_view": chain("raw", "SELECT * RENAME (yield_share AS yield) FROM raw"),
    "split_entities": chain("parts", "SELECT ord, coalesce(CASE WHEN reactants IS NOT NULL THEN array_to_string(r0, '~') END, '') AS reactants, coalesce(CASE WHEN products IS NOT NULL THEN array_to_string(p0, '~') END, '') AS products FROM parts"),
    "parse_reaction_string": chain("parts", "SELECT ord, CASE WHEN rxn_smiles IS NOT NULL THEN array_to_string(r0, '~') ELSE '' END AS reactants, CASE WHEN rxn_smiles IS NOT NULL THEN 'NaOH~K OH' ELSE '' END AS agents, CASE WHEN rxn_smiles IS NOT NULL THEN array_to_string(p0, '~') ELSE '' END AS products FROM parts"),
    "unit_quantities": chain("norm", 'SELECT ord, round(tk, 6) AS "temperature_K", ts AS time_s, pp AS "pressure_Pa", ph_n AS "pH" FROM cond'),
    "present_mask": chain("norm", "SELECT mask AS present_mask, count(*) AS n FROM cond GROUP BY mask"),
    "spectator_move": chain("parts", "SELECT ord, array_to_string(r, '~') AS reactants, array_to_string(p, '~') AS products, array_to_string(a, '~') AS agents, array_to_string(sp, '~') AS spectators FROM sides"),
    "role_scores": chain("norm", "SELECT DISTINCT m AS molecule, round(s, 6) AS score FROM score"),
    "solvent_resolution": chain("norm", "SELECT solvent, array_to_string(sol, '~') AS resolved, conf AS confidence, count(*) AS n FROM cond GROUP BY ALL"),
    "normalize_reactions": chain("norm", "SELECT ord, h AS reaction_hash_v1, main AS role_main_substrate, mask AS present_mask, conf AS solvent_confidence FROM good JOIN main USING (ord)"),
    "normalize_failures": chain("norm", "SELECT rxn_id, 'missing_reaction_components' AS failures, source FROM norm WHERE failed"),
    "failure_counts": chain("norm", "SELECT 'missing_reaction_components' AS failure, count(*) AS n FROM norm WHERE failed"),
    "normalization_summary": chain(
        "norm",
        "SELECT count(*) AS n_rows, count(*) FILTER (NOT failed) AS n_ok, round(count(*) FILTER (NOT failed) / count(*), 6) AS success_ratio, count(DISTINCT h) FILTER (NOT failed) AS n_distinct,"
        " count(*) FILTER (NOT failed) - count(DISTINCT h) FILTER (NOT failed) AS n_duplicates, round(avg(len(r)) FILTER (NOT failed), 6) AS mean_reactants, median(len(r)) FILTER (NOT failed) AS median_reactants,"
        " max(len(p)) FILTER (NOT failed) AS max_products, min(len(a)) FILTER (NOT failed) AS min_agents, (SELECT count(DISTINCT main) FROM main) AS n_substrates FROM norm",
    ),
    "normalization_warnings": chain("norm", "SELECT 'success ratio ' || format('{:.2f}', count(*) FILTER (NOT failed) / count(*)) || ' < 0.99' AS warning FROM norm HAVING count(*) FILTER (NOT failed) / count(*) < 0.99"),
    "clashing_columns": chain(
        "norm",
        "SELECT ord, CASE WHEN ord % 9 = 0 THEN (row_number() OVER (ORDER BY ord) - 1)::VARCHAR ELSE rxn_id END AS rxn_id, CASE WHEN ord % 2 = 0 THEN 3.0::DOUBLE ELSE ph_n END AS \"pH\","
        " CASE WHEN ord % 9 = 0 THEN (row_number() OVER (ORDER BY ord) - 1)::VARCHAR ELSE rxn_id END AS provenance FROM cond",
    ),
    "file_order_ids": chain("raw", "SELECT ord, (row_number() OVER (ORDER BY ord) - 1)::VARCHAR AS rxn_id FROM raw"),
    "unbalanced_molecules": "SELECT p_partkey::VARCHAR AS rxn_id, 'molecule_standardization' AS failures FROM part WHERE p_size % 10 = 0",
    "provenance_rows": chain("norm", "SELECT h AS reaction_hash_v1, ord, rxn_id FROM good"),
    "normalization_usage": chain("norm", usage(("present_mask_before", "mask", "good"), ("present_mask", "mask", "rx"), ("solvent", "unnest(sol)", "rx"), ("main_substrate", "main", "rx"))),
    "normalization_spread": chain("norm", spread(("reactants", "len(r)", "good"), ("products", "len(p)", "good"), ("agents", "len(a)", "good"))),
    "dedup_provenance": chain("norm", "SELECT rxn_vid, h AS reaction_hash_v1, rxn_id, provenance FROM rx"),
    "condition_keys": chain(
        "keys",
        'SELECT rxn_vid, cid AS cond_hash, cid[1:8] AS cond_hash_prefix, mask AS present_mask, tb AS "temp_K_bin", sb AS time_s_bin, pb AS "pressure_Pa_bin", hb AS "pH_bin", lower(atmo) AS atmosphere, lower(lig) AS light,'
        " lower(phase) AS phase, sk AS solvent_key, ck AS catalyst_key, ak AS agent_key, conf AS resolution_confidence FROM keys",
    ),
    "condition_groups": chain("keys", "SELECT cid AS cond_hash, count(*) AS n FROM keys GROUP BY cid"),
    "condition_summary": chain("keys", "SELECT count(*) AS n_rows, count(DISTINCT cid) AS n_conditions, round(avg(conf), 6) AS mean_confidence, round(median(conf), 6) AS median_confidence FROM keys"),
    "condition_usage": chain("keys", usage(*[(n, e, "keys") for n, e in (("cond_hash", "cid"), ("cond_hash_prefix", "cid[1:8]"), ("present_mask", "mask"), ("temp_K_bin", "tb"), ("time_s_bin", "sb"), ("pressure_Pa_bin", "pb"), ("pH_bin", "hb"), ("solvent_key", "sk"), ("catalyst_key", "ck"), ("agent_key", "ak"))])),
    "level1_clusters": chain("keys", """SELECT cid AS "CID", string_agg(rxn_vid::VARCHAR, ',' ORDER BY rxn_vid) AS rxn_vids FROM keys GROUP BY cid"""),
    "level1_members": chain("keys", """SELECT cid AS "CID", rxn_vid FROM keys"""),
    "unmapped_signatures": "SELECT p_partkey AS rxn_vid, 'unmapped' AS signature_type, sha256('R:' || w || '|P:' || reverse(w)) AS mech_sig_base, 'R:' || w || '~P:' || reverse(w) AS event_tokens, w AS scaffold_key FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS w FROM part)",
    "level2_members": chain("sig", """SELECT cid AS "CID", mid AS "MID", rxn_vid FROM sig"""),
    "multiset_delta": chain("sig", "SELECT rxn_vid, array_to_string(ev, '~') AS events FROM events"),
    "mechanism_signatures": chain(
        "sig",
        "SELECT rxn_vid, mid AS cluster_id, base AS mech_sig_base, CASE WHEN kind = 'mapped' THEN sha256('r1|' || array_to_string(tok, '|')) END AS mech_sig_r1, CASE WHEN kind = 'mapped' THEN sha256('r2|' || array_to_string(tok, '|')) END AS mech_sig_r2, kind AS signature_type, array_to_string(tok, '~') AS event_tokens,"
        " CASE WHEN kind = 'mapped' THEN len(list_filter(tok, lambda x: x LIKE '+O%')) ELSE 0 END AS redox_events, CASE WHEN kind = 'mapped' THEN len(list_filter(tok, lambda x: x LIKE '+C%')) ELSE 0 END AS ring_events, main AS scaffold_key, sha256(coarse)[1:32] AS coarse_key_hash FROM sig",
    ),
    "coarse_keys": chain("sig", "SELECT coarse AS coarse_text, count(*) AS n, count(DISTINCT cid) AS n_conditions FROM sig GROUP BY coarse"),
    "level2_clusters": chain("sig", "SELECT cid AS cond_hash, mid AS cluster_id, top AS mech_sig_base, coarse AS coarse_text, size AS rxn_count, diversity AS n_bases, vids AS rxn_vids FROM c2 JOIN (SELECT mid, string_agg(rxn_vid::VARCHAR, ',' ORDER BY rxn_vid) AS vids FROM sig GROUP BY mid) USING (mid)"),
    "mechanism_summary": chain(
        "sig",
        "SELECT count(*) AS n_rows, count(*) FILTER (kind = 'mapped') AS n_mapped, count(DISTINCT cid) AS n_conditions, count(DISTINCT base) AS n_bases, count(DISTINCT main) AS n_scaffolds, round(avg(len(tok)), 6) AS mean_tokens, median(len(tok)) AS median_tokens,"
        " count(*) FILTER (kind = 'mapped' AND len(list_filter(tok, lambda x: x LIKE '+O%')) > 0) AS n_redox, count(*) FILTER (kind = 'mapped' AND len(list_filter(tok, lambda x: x LIKE '+C%')) > 0) AS n_ring, 0::BIGINT AS n_stereo FROM sig",
    ),
    "mechanism_percentiles": chain("sig", "SELECT unnest([10, 25, 50, 75, 90]) AS p, unnest(list_transform(q, lambda x: round(x, 6))) AS value FROM (SELECT quantile_cont(size::DOUBLE, [0.1, 0.25, 0.5, 0.75, 0.9]) AS q FROM c2)"),
    "mechanism_usage": chain("sig", usage(*[(n, e, "sig") for n, e in (("signature_type", "kind"), ("mech_sig_base", "base"), ("event_token", "unnest(tok)"), ("scaffold_key", "main"), ("coarse_key", "coarse"), ("scaffold_family", "fam"))], ("clusters_of_condition", "cid", "c2"))),
    "mechanism_spread": chain("sig", spread(("event_tokens", "len(tok)", "sig"), ("rxn_count", "size", "c2"), ("n_bases", "diversity", "c2"))),
    "single_condition_keys": chain("sig", "SELECT coarse AS coarse_text, count(*) AS n FROM sig GROUP BY coarse HAVING count(DISTINCT cid) = 1 ORDER BY n DESC, coarse LIMIT 5"),
    "largest_clusters": chain("sig", "SELECT mid AS cluster_id, coarse AS coarse_text, size AS rxn_count FROM c2 ORDER BY size DESC, mid LIMIT 5"),
    "family_sizes": chain("sig", "SELECT split_part(coarse, '|', 1) AS family, count(*) AS n_clusters, round(avg(size), 6) AS mean_size FROM c2 GROUP BY 1"),
    "event_family_sizes": chain(
        "sig", "SELECT f AS family, count(*) AS n_clusters, round(avg(size), 6) AS mean_size FROM (SELECT DISTINCT ff.f, sig.mid, c2.size FROM ff JOIN sig USING (rxn_vid) JOIN c2 ON c2.mid = sig.mid) GROUP BY f"
    ),
    "fingerprint_bits": chain("feat", """SELECT rxn_vid, cid AS "CID", mid AS "MID", main AS scaffold_key, array_to_string(bits, ',') AS fingerprint_bits FROM feat"""),
    "canopy_clusters": chain("sids", """SELECT rxn_vid, sid AS "SID" FROM sids"""),
    "level3_clusters": chain("sids", """SELECT cid AS "CID", mid AS "MID", sid AS "SID", array_to_string(list(rxn_vid ORDER BY rxn_vid), ',') AS rxn_vids, array_to_string(list(rxn_vid ORDER BY rxn_vid)[1:3], ',') AS exemplar_vids, count(*) AS cluster_size FROM sids GROUP BY ALL"""),
    "ann_manifest": chain("feat", "SELECT cid, mid, count(*) AS size, 32 AS m, 400 AS efc FROM feat GROUP BY cid, mid"),
    "ann_search": chain(
        "feat",
        "SELECT query, place, rxn_vid, round(s, 6) AS similarity FROM (SELECT query, rxn_vid, s, row_number() OVER (PARTITION BY query ORDER BY s DESC, rxn_vid)::INT AS place FROM (SELECT a.rxn_vid AS query, b.rxn_vid,"
        " len(list_intersect(a.bits, b.bits))::DOUBLE / (len(a.bits) + len(b.bits) - len(list_intersect(a.bits, b.bits))) AS s FROM feat a JOIN feat b ON a.cid = b.cid AND a.mid = b.mid WHERE a.rxn_vid % 100 = 0)) WHERE place <= 5",
    ),
    "level3_members": chain("sids", """SELECT cid AS "CID", mid AS "MID", sid AS "SID", rxn_vid FROM sids"""),
    "silent_structures": "SELECT 'all fingerprints are equal' AS warning FROM region HAVING count(*) > 1 UNION ALL SELECT count(*) || ' reactions have no event' FROM region",
    "ann_stand_in": chain("feat", "SELECT rxn_vid AS query, unnest(range(least(5, n)))::INT AS place FROM (SELECT rxn_vid, count(*) OVER (PARTITION BY cid, mid) AS n FROM feat)"),
    "structure_summary": chain(
        "feat",
        "SELECT count(*) AS n_rows, round(avg(len(bits)), 6) AS mean_bits, median(len(bits)) AS median_bits, min(len(bits)) AS min_bits, max(len(bits)) AS max_bits, count(DISTINCT bits) AS n_patterns, count(*) FILTER (len(bits) = 0) AS n_empty,"
        " count(DISTINCT (cid, mid)) AS n_groups, count(*) FILTER (main = 'unknown') AS n_unknown_scaffold FROM feat",
    ),
    "structure_usage": chain("feat", usage(("token", "unnest(tks)", "fx"), ("event", "unnest(list_filter(tks, lambda x: x LIKE 'event:%'))", "fx"), ("mechanism", "'mech:' || base", "fx"), ("scaffold_key", "main", "fx"), ("group", "cid || '|' || mid", "fx")), TOKENS),
    "structure_spread": chain("feat", spread(("bits", "len(bits)", "feat"), ("tokens", "len(tks)", "fx"), ("events", "len(list_filter(tks, lambda x: x LIKE 'event:%'))", "fx")), TOKENS),
    "structure_warnings": chain("feat", "SELECT 'all fingerprints are equal' AS warning FROM feat HAVING count(*) > 1 AND count(DISTINCT bits) <= 1 UNION ALL SELECT count(*) || ' reactions have no event' FROM sig WHERE len(tok) = 0 HAVING count(*) > 0"),
    "sampled_similarity": chain(
        "feat",
        "SELECT count(*) AS n_pairs, round(avg(s), 6) AS mean, round(median(s), 6) AS median, round(min(s), 6) AS low, round(max(s), 6) AS high FROM (SELECT len(list_intersect(a.bits, b.bits))::DOUBLE / (len(a.bits) + len(b.bits) - len(list_intersect(a.bits, b.bits))) AS s"
        " FROM (FROM feat ORDER BY rxn_vid LIMIT 200) a JOIN (FROM feat ORDER BY rxn_vid LIMIT 200) b ON a.rxn_vid < b.rxn_vid)",
    ),
    "merge_assignments": chain("sids", """SELECT rxn_vid, cid AS "CID", mid AS "MID", sid AS "SID" FROM sids"""),
    "cluster_cards": chain("sids", "SELECT * FROM cards", CARD),
    "clusters_final": chain("sids", """SELECT rxn_vid, sids.sid AS "SID", size AS card_size, dominant_scaffold, sids.cid AS "CID", sids.mid AS "MID", yield_count, exemplars, top_solvents, top_temperatures, mechanism_summary FROM sids JOIN cards ON sids.sid = cards."SID" """, CARD),
    "cross_view_edges": f"WITH {EDGES} SELECT a.kind, a.shared_id, a.\"CID\" AS source, b.\"CID\" AS target, least(a.n, b.n) AS weight FROM ac a JOIN ac b ON a.kind = b.kind AND a.shared_id = b.shared_id AND a.\"CID\" < b.\"CID\"",
    "cross_view_classes": f'WITH {EDGES} SELECT kind, shared_id, count(*) AS conditions, sum(n)::BIGINT AS reactions, max(n) AS largest FROM ac GROUP BY kind, shared_id HAVING count(*) > 1',
    "stats_jsonl": chain("sids", """SELECT 'cluster_card' AS type, count(*) AS n FROM cards""", CARD),
    "top_values": "SELECT o_orderstatus, string_agg(o_orderpriority || '=' || n, ';' ORDER BY n DESC, o_orderpriority) AS top FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n, row_number() OVER (PARTITION BY o_orderstatus ORDER BY count(*) DESC, o_orderpriority) AS pl FROM orders GROUP BY 1, 2) WHERE pl <= 3 GROUP BY 1",
    "yield_summary": "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS yield_mean, round(median(c_acctbal), 4) AS yield_median, count(c_acctbal) AS yield_count FROM customer GROUP BY 1",
    "cluster_metrics": chain("sig", "SELECT mid AS cluster_id, size AS rxn_count, diversity::INT AS base_diversity, abs(round(ent, 6)) AS base_entropy, round(share, 6) AS top1_base_share, split_part(coarse, '|', 1) AS coarse_scaffold FROM c2"),
    "signature_metrics": chain("sig", "SELECT mid AS cluster_id, abs(round(event_entropy, 6)) AS event_entropy, round(event_token_mean, 6) AS event_token_mean, round(mapped_share, 6) AS mapped_share FROM sm", ENTROPY),
    "cluster_enriched": chain("sig", "SELECT c2.mid AS cluster_id, size AS rxn_count, abs(round(event_entropy, 6)) AS event_entropy, round(mapped_share, 6) AS mapped_share FROM c2 LEFT JOIN sm ON c2.mid = sm.mid", ENTROPY),
    "size_histogram": chain(
        "sig",
        "SELECT bin, round(low + bin * step, 6) AS low, round(low + (bin + 1) * step, 6) AS high, count(*) AS n FROM (SELECT low, step, CASE WHEN step > 0 THEN least(floor((size - low) / step), bins - 1) ELSE 0 END::BIGINT AS bin FROM"
        " (SELECT size, s.low, bins, (s.high - s.low)::DOUBLE / bins AS step FROM c2, (SELECT *, CASE WHEN w > 0 THEN greatest(5, least(80, floor((high - low) / w))) ELSE 30 END::BIGINT AS bins FROM"
        " (SELECT min(size) AS low, max(size) AS high, 2 * (quantile_cont(size::DOUBLE, 0.75) - quantile_cont(size::DOUBLE, 0.25)) / pow(count(*), 1.0::DOUBLE / 3) AS w FROM c2)) s)) GROUP BY bin, low, step",
    ),
    "cumulative_coverage": chain("sig", "SELECT round(row_number() OVER w / count(*) OVER ()::DOUBLE, 9) AS x, round(sum(size) OVER w / sum(size) OVER ()::DOUBLE, 9) AS y FROM c2 WINDOW w AS (ORDER BY size DESC, mid ROWS UNBOUNDED PRECEDING)"),
    "size_entropy_points": chain("sig", "SELECT size AS x, abs(round(ent, 6)) AS y, count(*) AS n FROM c2 GROUP BY ALL"),
    "size_top1_points": chain("sig", "SELECT size AS x, round(share, 6) AS y, count(*) AS n FROM c2 GROUP BY ALL"),
    "entropy_correlation": chain("sig", "SELECT count(*) AS n, round(corr(size, ent), 6) AS r FROM c2"),
    "event_entropy_correlation": chain("sig", "SELECT count(*) AS n, round(corr(ent, event_entropy), 6) AS r FROM c2 JOIN sm ON c2.mid = sm.mid", ENTROPY),
    "entropy_pair_points": chain("sig", "SELECT abs(round(ent, 6)) AS x, abs(round(event_entropy, 6)) AS y, count(*) AS n FROM c2 JOIN sm ON c2.mid = sm.mid GROUP BY ALL", ENTROPY),
    "entropy_by_scaffold": chain("sig", "SELECT split_part(coarse, '|', 1) AS coarse_scaffold, array_to_string(list_transform(quantile_cont(ent, [0.0, 0.25, 0.5, 0.75, 1.0]), lambda x: round(abs(x) * 1000)::BIGINT), ',') AS q, count(*) AS n FROM c2 GROUP BY 1"),
    "mapped_share_histogram": chain("sig", "SELECT least(floor(mapped_share * 20) + 1, 20)::BIGINT AS bin, count(*) AS n FROM sm GROUP BY 1", ENTROPY),
    "coherence_overview": chain(
        "sig",
        "SELECT count(*) AS n_clusters, sum(size)::BIGINT AS n_reactions, min(size) AS min_size, median(size::DOUBLE) AS median_size, quantile_cont(size::DOUBLE, 0.9) AS p90_size, max(size) AS max_size, abs(round(median(ent), 6)) AS median_entropy, round(median(share), 6) AS median_top1 FROM c2",
    ),
}
ORACLE["edge_lines"] = ORACLE["cross_view_edges"]
