"""Merkle manifest of a dataset: a content-addressed DAG of digests, and inclusion proofs by descent.

Every row is a leaf, the digest of its columns.  Within a group (a language) the leaves stand in
order of their id, and every ``FANOUT`` consecutive nodes are hashed into one until one is left;
the groups' last nodes, in order of the group, form the top tree in the same way.

* The store holds one record per inner node: its digest and its children's digests.  It is written
  level by level; a level has an eighth of the rows of the one below.
* Proofs go down from the root.  A request's rank, written in base ``FANOUT``, says which child is
  taken; a join on the digest fetches the record and the children that aren't taken become one
  segment of the path.  Requests that agree in their leading digits share these steps, so a level
  has as many rows as it has nodes, and only the last step fans out to the leaves.  There the
  segments, gathered from the root downwards, are reversed.

DataFrame operations only.  A join is keyed by a digest or a node's place, and no window or group
holds more than ``FANOUT`` rows; the one table of groups is read through its own order.

Defined results: null columns are written as ``-`` (so null and empty differ); a null group comes
first, then UTF-8 byte order; a null id comes first; rows of one id stand in order of their digest,
and equal rows are leaves of their own; no rows give no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import write_table
from tessera.operators.indexing import dense_index

FANOUT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One step of a path: what stands before and behind the selected child.
SEGMENTS = "array<struct<before:string,behind:string>>"


def field(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def leaf_digest(columns: Sequence[Column]) -> Column:
    return digest(F.concat(*map(field, columns)))


def _levels(n: int) -> int:
    """Times that n nodes must be grouped until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _height(n: Column, most: int) -> Column:
    """``_levels`` of a column, for trees of at most ``most`` levels."""
    out = F.lit(most)
    for k in range(most - 1, -1, -1):
        out = F.when(n <= FANOUT ** k, F.lit(k)).otherwise(out)
    return out.cast("int")


def build(leaves: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame, DataFrame | None]:
    """The store by level, the roots of a forest, and the nodes above the leaves (None without any).

    ``leaves``: tree, n (leaves of the tree), idx (from 0), digest.  Level k of the store (from 1):
    digest, children.  Roots: tree, n, digest.  Nodes: tree, n, idx, digest, children."""
    nodes, store, lowest = leaves, [], None
    roots = nodes.where("n = 1")
    for k in range(1, most + 1):
        grown = nodes.where(F.col("n") > FANOUT ** (k - 1)).groupBy(
            "tree", "n", F.expr(f"idx div {FANOUT}").alias("parent")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"]).alias("children"))
        level = write_table(grown.select("tree", "n", F.col("parent").alias("idx"),
                                         digest(F.array_join("children", "")).alias("digest"), "children"))
        # Content-addressed: equal nodes are one record.
        store.append(level.select("digest", "children").dropDuplicates(["digest"]))
        lowest = level if lowest is None else lowest
        nodes = level.drop("children")
        roots = roots.unionByName(nodes.where(F.col("n").between(FANOUT ** (k - 1) + 1, FANOUT ** k)))
    return store, roots.select("tree", "n", "digest"), lowest


def _segment(children: Column, taken: Column) -> Column:
    """The children that aren't taken, in order, in front of and behind the one that is."""
    return F.struct(F.array_join(F.slice(children, 1, taken), "").alias("before"),
                    F.array_join(F.slice(children, taken + 2, F.greatest(F.size(children) - taken - 1, F.lit(0))), "").alias("behind"))


def descend(roots: DataFrame, store: list[DataFrame], most: int, stop: int, keep: tuple = ()) -> DataFrame:
    """Nodes of height ``stop`` with their paths: tree, n, the columns of ``keep``, idx, digest, path
    (from the root down).

    ``roots``: tree, n, digest, path and ``keep``.  Trees that are lower than ``stop`` stay out.  The
    joins are merge joins at every size; a digest that many nodes share is a skewed key, which
    adaptive execution splits."""
    roots = roots.withColumn("height", _height(F.col("n"), most)).withColumn("idx", F.lit(0).cast("bigint"))
    columns = ["tree", "n", *keep, "idx", "digest", "path"]
    at = roots.where(F.col("height") == most).select(columns)
    for k in range(most, stop, -1):
        record = store[k - 1].withColumnRenamed("digest", "parent")
        met = at.join(record.hint("merge"), F.col("digest") == F.col("parent"))
        down = met.select("tree", "n", *keep, "idx", "path", "children", F.posexplode("children").alias("digit", "digest")).select(
            "tree", "n", *keep, (F.col("idx") * FANOUT + F.col("digit")).alias("idx"), "digest",
            F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"))
        at = down.unionByName(roots.where(F.col("height") == k - 1).select(columns))
    return at


def joined(path: Column) -> Column:
    """All siblings of a path, segment by segment."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["behind"])), "")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path (from the leaf up) lead to."""
    return F.aggregate(path, start, lambda acc, s: digest(F.concat(s["before"], acc, s["behind"])))


def prove(rows: DataFrame, group_col: str, id_col: str, leaf_col: str, claim_col: str) -> DataFrame:
    """One row per row of ``rows``: id, group, claim, leaf, subroot, root, path (segments from the
    leaf up).  ``claim_col`` is carried along; fold it with the path to check it against the root.
    """
    # Written first: range partitioning reads its input twice, and digests of texts are dear.
    ranked = write_table(rows.select(F.col(group_col).alias("grp"), F.col(id_col).alias("id"), F.col(leaf_col).alias("leaf"),
                                     F.col(claim_col).alias("claim"), F.monotonically_increasing_id().alias("tie")))
    ranked = dense_index(ranked, ["grp", "id", "leaf", "tie"], "at")
    groups = write_table(ranked.groupBy("grp").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")))
    size = groups.agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("n")).first()
    if not size["groups"]:
        return rows.sparkSession.createDataFrame(
            [], f"id {rows.schema[id_col].dataType.simpleString()}, grp {rows.schema[group_col].dataType.simpleString()}, "
                f"claim string, leaf string, subroot string, root string, path {SEGMENTS}")
    high, top_high = _levels(size["n"]), _levels(size["groups"])
    groups = write_table(dense_index(groups, ["grp"], "tree"))
    own = groups.withColumnRenamed("grp", "own")
    leaves = write_table(ranked.join(own, F.col("grp").eqNullSafe(F.col("own"))).select(
        "tree", "n", (F.col("at") - F.col("first")).alias("idx"), "id", "grp", "leaf", "claim"))

    store, subroots, lowest = build(leaves.select("tree", "n", "idx", F.col("leaf").alias("digest")), high)
    subroots = write_table(subroots)
    tops = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.lit(size["groups"]).cast("bigint").alias("n"),
                           F.col("tree").alias("idx"), "digest")
    top_store, top, _ = build(tops, top_high)
    root = top.select("digest").first()["digest"]

    start = top.withColumn("path", F.array().cast(SEGMENTS))
    paths = descend(start, top_store, top_high, 0).select(F.col("idx").alias("tree"), F.col("digest").alias("subroot"), "path")
    starts = write_table(paths.join(subroots.select("tree", "n"), "tree"))

    columns = ["id", "grp", "claim", "leaf", "subroot", "path"]
    found = leaves.where("n = 1").join(starts.drop("n"), "tree").select(columns)
    if high:
        # Nodes above the leaves, with the record of each and the requests below it; these rows are
        # small, and the one path that all leaves of a node share is shuffled once.
        last = descend(starts.select("tree", "n", "subroot", F.col("subroot").alias("digest"), "path"), store, high, 1, ("subroot",))
        asked = leaves.where("n > 1").groupBy("tree", F.expr(f"idx div {FANOUT}").alias("idx")).agg(
            F.collect_list(F.struct((F.col("idx") % FANOUT).cast("int").alias("digit"), "id", "grp", "claim")).alias("requests"))
        record = lowest.select("tree", "idx", "digest", "children").join(asked.hint("merge"), ["tree", "idx"])
        met = last.join(record.hint("merge"), ["tree", "idx", "digest"]).select("subroot", "children", "path", F.inline("requests"))
        found = found.unionByName(met.withColumn("leaf", F.element_at("children", F.col("digit") + 1)).withColumn(
            "path", F.concat("path", F.array(_segment(F.col("children"), F.col("digit"))))).select(columns))
    return found.select("id", "grp", "claim", "leaf", "subroot", F.lit(root).alias("root"), F.reverse("path").alias("path"))


def tampered_text(text: Column) -> Column:
    """A-Z in lower case; null stays."""
    return F.translate(text, UPPER, LOWER)


def manifest(docs: DataFrame, tampered: Column, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """Leaves, roots, proofs and checks of a documents table: doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified.

    Rows where ``tampered`` holds claim a leaf whose text is in lower case; the others claim their own."""
    doc_id, source, lang, n_chars, text = map(F.col, columns)
    changed = F.coalesce(tampered, F.lit(False)) & (tampered_text(text) != text)
    rows = docs.select(doc_id.alias("id"), lang.alias("grp"), leaf_digest([doc_id, source, lang, n_chars, text]).alias("leaf"),
                       F.when(changed, leaf_digest([doc_id, source, lang, n_chars, tampered_text(text)])).alias("claim"))
    proofs = prove(rows, "grp", "id", "leaf", "claim")
    out = proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", digest(joined(F.col("path"))).alias("proof_sha256"),
                        fold(F.coalesce("claim", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def crc32_sql(expression: str) -> str:
    """Unsigned CRC-32 of an ASCII string, in DuckDB SQL: one step a byte and one a bit."""
    steps = f"flatten(list_transform(string_split({expression}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda a, b: {step}), 4294967295)"


def oracle_sql() -> str:
    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    return f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, lang, {leaf('text')} AS leaf,
         CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS claim
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM rows_),
trees(lang, lvl, idx, digest, m) AS (
  SELECT lang, 0, idx, leaf, count(*) OVER (PARTITION BY lang) FROM ranked
  UNION ALL
  SELECT lang, lvl + 1, idx // {FANOUT}, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(m) + {FANOUT - 1}) // {FANOUT}
  FROM trees WHERE m > 1 GROUP BY lang, lvl, idx // {FANOUT}),
subroots AS (
  SELECT lang, digest AS subroot, lvl AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM trees WHERE m = 1),
top(lvl, idx, digest, m) AS (
  SELECT 0, place, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // {FANOUT}, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(m) + {FANOUT - 1}) // {FANOUT}
  FROM top WHERE m > 1 GROUP BY lvl, idx // {FANOUT}),
root AS (SELECT digest AS root, lvl AS height FROM top WHERE m = 1),
steps AS (
  SELECT r.lang, r.idx AS leaf_idx, t.lvl,
         coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx < r.idx // ({FANOUT} ** t.lvl)::BIGINT), '') AS before,
         coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx > r.idx // ({FANOUT} ** t.lvl)::BIGINT), '') AS behind
  FROM ranked r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang
  JOIN trees t ON t.lang IS NOT DISTINCT FROM r.lang AND t.lvl < s.height
    AND t.idx // {FANOUT} = r.idx // ({FANOUT} ** (t.lvl + 1))::BIGINT
  GROUP BY r.lang, r.idx, t.lvl
  UNION ALL
  SELECT r.lang, r.idx, s.height + t.lvl,
         coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx < s.place // ({FANOUT} ** t.lvl)::BIGINT), ''),
         coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx > s.place // ({FANOUT} ** t.lvl)::BIGINT), '')
  FROM ranked r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang
  JOIN top t ON t.lvl < (SELECT height FROM root) AND t.idx // {FANOUT} = s.place // ({FANOUT} ** (t.lvl + 1))::BIGINT
  GROUP BY r.lang, r.idx, s.height, t.lvl),
proofs AS (
  SELECT lang, leaf_idx, sha256(string_agg(before || behind, '' ORDER BY lvl)) AS proof_sha256 FROM steps GROUP BY lang, leaf_idx),
folded(lang, idx, lvl, digest) AS (
  SELECT lang, idx, 0, coalesce(claim, leaf) FROM ranked
  UNION ALL
  SELECT f.lang, f.idx, f.lvl + 1, sha256(s.before || f.digest || s.behind)
  FROM folded f JOIN steps s ON f.lang IS NOT DISTINCT FROM s.lang AND f.idx = s.leaf_idx AND f.lvl = s.lvl),
last AS (SELECT lang, idx, arg_max(digest, lvl) AS folded_root FROM folded GROUP BY lang, idx)
SELECT r.doc_id, r.leaf, s.subroot, root.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, l.folded_root,
       l.folded_root = root.root AS verified
FROM ranked r CROSS JOIN root
JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang
LEFT JOIN proofs p ON r.lang IS NOT DISTINCT FROM p.lang AND r.idx = p.leaf_idx
JOIN last l ON r.lang IS NOT DISTINCT FROM l.lang AND r.idx = l.idx
"""
