"""Queries that compare documents with each other or share out a budget among them."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import merkle, mixing, near_copies, token_alignment
from riskweave.llm.registry import documents, query

WORD = r"[^\x20\x09-\x0D]+"


@query("op6_near_copies")
def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.groups(documents(spark, sf_dir), near_copies.Settings(words=2))


# Which domain a source belongs to is a parameter of the mix; here it goes by the source's number.
DOMAIN = """CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8', 'src9') THEN 'web'
WHEN source IN ('src10', 'src11', 'src12', 'src13', 'src14') THEN 'books'
WHEN source IN ('src15', 'src16', 'src17', 'src18', 'src19') THEN 'reference' ELSE 'other' END"""
WEIGHTS = {"domain": {"web": 4, "books": 4, "reference": 2}, "lang": {"en": 5, "de": 3, "fr": 2, "es": 2}}
MIX = mixing.Plan(levels=(("domain", DOMAIN), ("lang", "lang"), ("source", "source")), weights=WEIGHTS, budget_share=700, max_epochs=2, seed=7)


def _weight_sql(plan: mixing.Plan, level: str) -> str:
    cases = " ".join(f"WHEN {level} = '{name}' THEN {weight}" for name, weight in plan.weights.get(level, {}).items())
    return f"CASE {cases} ELSE 1 END" if cases else "1"


def mixing_sql(plan: mixing.Plan, source: str, body: str) -> str:
    """The plan in SQL: the documents ``taken``, with their epochs."""
    names = plan.names
    budget = str(plan.budget) if plan.budget is not None else f"(SELECT sum(tokens) * {plan.budget_share} // 1000 FROM leaves)"
    steps, above = [], "leaf0"
    for depth, level in enumerate(names):
        keys, family = ", ".join(names[: depth + 1]), ", ".join(names[:depth])
        part = f"PARTITION BY {family}" if family else ""
        order = f"{part} ORDER BY ratio, {level} NULLS FIRST"
        same = " AND ".join(f"l.{k} IS NOT DISTINCT FROM n.{k}" for k in names[: depth + 1])
        steps.append(f"""
n{depth} AS (SELECT {keys}, any_value(budget) AS given, any_value(w_{level})::HUGEINT AS w, sum(room)::HUGEINT AS node_room,
             CASE WHEN any_value(w_{level}) > 0 THEN sum(room)::DOUBLE / any_value(w_{level})::DOUBLE ELSE 0 END AS ratio FROM {above} GROUP BY {keys}),
o{depth} AS (SELECT *, given - coalesce(sum(node_room) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
             sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM n{depth}),
f{depth} AS (SELECT *, node_room * w_left <= w * left_over AS is_full FROM o{depth}),
s{depth} AS (SELECT *, CASE WHEN is_full THEN node_room ELSE
             w * (given - coalesce(sum(node_room) FILTER (WHERE is_full) OVER ({part}), 0)) // sum(w) FILTER (WHERE NOT is_full) OVER ({part}) END AS share FROM f{depth}),
leaf{depth + 1} AS (SELECT l.* REPLACE (n.share AS budget) FROM {above} l JOIN s{depth} n ON {same})""")
        above = f"leaf{depth + 1}"
    columns = ", ".join(names)
    same = " AND ".join(f"z.{k} IS NOT DISTINCT FROM l.{k}" for k in names)
    dead = " OR ".join(f"w_{n} <= 0" for n in names)
    return f"""
WITH sizes AS (SELECT doc_id, {", ".join(f"{e} AS {n}" for n, e in plan.levels)}, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_tokens FROM {source}),
leaves AS (SELECT {columns}, count(*) AS n_rows, sum(n_tokens)::HUGEINT AS tokens, {", ".join(f"{_weight_sql(plan, n)} AS w_{n}" for n in names)} FROM sizes GROUP BY {columns}),
roomy AS (SELECT *, CASE WHEN {dead} THEN 0 ELSE tokens * {plan.max_epochs} END AS room FROM leaves),
leaf0 AS (SELECT *, least({budget}, (SELECT sum(room) FROM roomy))::HUGEINT AS budget FROM roomy),
{",".join(steps)},
cuts AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END::BIGINT AS epochs FROM {above}),
keyed AS (SELECT z.*, l.epochs, l.budget - l.epochs * l.tokens AS rest, md5('{plan.seed}:' || l.epochs || ':' || coalesce(z.doc_id::VARCHAR, '')) AS key
          FROM sizes z JOIN cuts l ON {same}),
ran AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {columns} ORDER BY key, coalesce(doc_id::VARCHAR, '')) AS upto FROM keyed),
taken AS (SELECT doc_id, {columns}, n_tokens, unnest(range(0, least({plan.max_epochs}, epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END)))::BIGINT AS epoch FROM ran)
{body}"""


@query("op7_source_mix", mixing_sql(MIX, "documents", "SELECT * FROM taken"))
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.selected(documents(spark, sf_dir), MIX)


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def manifest_sql() -> str:
    """The trees level by level; crc32 half a byte at a time, as DuckDB has none."""

    def field(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    table = [functools.reduce(lambda c, _: c >> 1 ^ (0xEDB88320 if c & 1 else 0), range(4), i) for i in range(16)]
    halves = "list_transform(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x) & 15, ascii(x) >> 4])), lambda x: x::BIGINT)"
    crc = f"xor(list_reduce([4294967295::BIGINT] || {halves}, lambda crc, b: xor(crc >> 4, list_extract({table}::BIGINT[], (xor(crc, b) & 15) + 1))), 4294967295)"
    way = """
way_{n} AS (SELECT w.{id}, k.lvl, string_agg(k.digest, '' ORDER BY k.idx) FILTER (WHERE k.idx < w.at) AS lefts, string_agg(k.digest, '' ORDER BY k.idx) FILTER (WHERE k.idx > w.at) AS rights
    FROM (SELECT s.grp, s.{id}, l.lvl, s.idx // (3 ** l.lvl)::BIGINT AS at FROM {n} s, (SELECT DISTINCT lvl FROM {n} WHERE n > 1) l WHERE s.lvl = 0) w
    JOIN {n} k ON k.grp IS NOT DISTINCT FROM w.grp AND k.lvl = w.lvl AND k.idx // 3 = w.at // 3 AND k.n > 1 GROUP BY w.{id}, k.lvl)"""
    tree = """
{n} AS (SELECT {grp} AS grp, 0 AS lvl, row_number() OVER (PARTITION BY {grp} ORDER BY {order}) - 1 AS idx, digest, count(*) OVER (PARTITION BY {grp}) AS n, {id} FROM {rows}
    UNION ALL SELECT grp, lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3, any_value({id}) FROM {n} WHERE n > 1 GROUP BY grp, lvl, idx // 3, n)"""
    return f"""
WITH RECURSIVE leaves AS (SELECT doc_id, source, {leaf("text")} AS digest, CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS altered FROM documents),
{tree.format(n="nodes", grp="source", order="doc_id", rows="leaves", id="doc_id")},
subroots AS (SELECT grp AS source, digest FROM nodes WHERE n = 1),
{tree.format(n="tops", grp="0", order="source NULLS FIRST", rows="subroots", id="source")},
{way.format(n="nodes", id="doc_id")},
{way.format(n="tops", id="source")},
steps AS (SELECT doc_id, lvl AS step, coalesce(lefts, '') AS lefts, coalesce(rights, '') AS rights FROM way_nodes
    UNION ALL SELECT doc_id, 100 + lvl, coalesce(lefts, ''), coalesce(rights, '') FROM leaves JOIN way_tops ON leaves.source IS NOT DISTINCT FROM way_tops.source),
ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY step) AS turn FROM steps),
folds AS (SELECT doc_id, 0 AS done, altered AS digest FROM leaves
    UNION ALL SELECT f.doc_id, f.done + 1, sha256(o.lefts || f.digest || o.rights) FROM folds f JOIN ordered o ON o.doc_id = f.doc_id AND o.turn = f.done + 1),
ends AS (SELECT doc_id, arg_max(digest, done) AS folded_root FROM folds GROUP BY doc_id),
proofs AS (SELECT doc_id, string_agg(lefts || rights, '' ORDER BY step) AS proof FROM steps GROUP BY doc_id),
root AS (SELECT digest AS root FROM tops WHERE n = 1)
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN ends USING (doc_id) LEFT JOIN proofs USING (doc_id), root"""


@query("op13_merkle_manifest", manifest_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    return merkle.manifest(documents(spark, sf_dir), altered={"text": text}, where=merkle.altered_rows("doc_id"))
