"""A Merkle tree over the rows of a table, and each row's proof.

Every node carries the interval of leaf ranks it covers. Nodes of one level fall into buckets of
one parent's width, so a node finds its parent by an equal bucket and containment of intervals;
its siblings are what its own interval leaves of the parent's. Paths are attached from the root
down, run by run: the wide rows of a path meet the leaves once, in an eighth of their number.

Each group of rows has a tree of its own, and the groups' roots, in order, have the tree above.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.operators import ordering
from corpusflow.session import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"


def _shown(value: Column) -> Column:
    """A value with its length in UTF-8 bytes, ``-`` for none."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(_shown, values)), 256)


def _joined(children: Column) -> Column:
    return F.concat_ws("", F.transform(children, lambda c: c["digest"]))


def _runs(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each level, from the lowest, and ``tree, height, digest`` of the roots.

    ``nodes`` has ``tree, lo, hi, digest, leaves``. A run is the node above its children: ``tree,
    lo, hi, digest, leaves, children``. Only the number of levels comes to the driver.
    """
    most = nodes.agg(F.max("leaves").alias("n")).first()["n"] or 0
    columns = ["tree", "lo", "hi", "digest", "leaves"]
    levels, roots, width = [], [nodes.filter("leaves = 1").select("tree", F.lit(0).alias("height"), "digest")], 1
    while width < most:
        below = nodes.filter(F.col("leaves") > width)
        width *= fanout
        grouped = below.groupBy("tree", "leaves", F.expr(f"lo div {width}L").alias("bucket")).agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")
        )
        run = grouped.select(
            "tree",
            F.expr("children[0].lo").alias("lo"),
            F.expr("children[size(children) - 1].hi").alias("hi"),
            F.sha2(_joined(F.col("children")), 256).alias("digest"),
            "leaves",
            "children",
        )
        levels.append(stored(run, "merkle-level"))
        nodes = levels[-1].select(columns)
        roots.append(nodes.filter("hi - lo = leaves").select("tree", F.lit(len(levels)).alias("height"), "digest"))
    top = roots[0]
    for more in roots[1:]:
        top = top.unionByName(more)
    return levels, top


def _below(members: DataFrame, above: DataFrame, width: int, keep: Sequence[str]) -> DataFrame:
    """``members`` with the path of the run that contains them, and their own siblings before it.

    ``above`` has ``tree, lo, hi, children, path, root``; runs of ``width`` leaves.
    """
    m = members.withColumn("bucket", F.expr(f"lo div {width}L")).alias("m")
    a = above.withColumn("bucket", F.expr(f"lo div {width}L")).alias("a")
    inside = (F.col("a.lo") <= F.col("m.lo")) & (F.col("m.hi") <= F.col("a.hi"))
    met = m.join(a, (F.col("m.tree") == F.col("a.tree")) & (F.col("m.bucket") == F.col("a.bucket")) & inside)
    left = F.filter("a.children", lambda c: c["hi"] <= F.col("m.lo"))
    right = F.filter("a.children", lambda c: c["lo"] >= F.col("m.hi"))
    own = F.array(F.struct(_joined(left).alias("left"), _joined(right).alias("right")))
    return met.select(*[F.col(f"m.{c}").alias(c) for c in keep], F.concat(own, F.col("a.path")).alias("path"), F.col("a.root"))


def _paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int, keep: Sequence[str]) -> DataFrame:
    """``leaves`` with ``path, root``, from the paths of their trees' roots (``tops``)."""
    above = None
    for level in reversed(range(len(levels) + 1)):
        nodes, columns = (levels[level - 1], ["tree", "lo", "hi", "children"]) if level else (leaves, list(keep))
        whole = nodes.filter("hi - lo = leaves").select(*columns).join(tops, "tree").select(*columns, "path", "root")
        if above is None:
            above = whole
        else:
            above = _below(nodes, above, fanout ** (level + 1), columns).unionByName(whole)
    return above


def _ranked(rows: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    ranked = ordering.positions(rows, groups, order, "lo", "leaves")
    return ranked.withColumn("hi", F.col("lo") + 1)


def manifest(
    docs: DataFrame,
    altered: Mapping[str, Column] | None = None,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    key: str = "doc_id",
    fanout: int = FANOUT,
) -> DataFrame:
    """``key, leaf, checked, subroot, root, path`` of each row.

    A leaf hashes the ``fields``. Leaves of one ``group`` value rise by ``key``, rows without a
    key last, rows of one key by their digest; the trees' roots rise by group value in bytes,
    rows without one first. ``path`` holds the digests left and right of the node on each level
    up to ``root``. ``checked`` is the leaf with the ``altered`` values in place of the fields'.

    One row per input row, repeated rows included; NULL and empty values have digests of their
    own; a table of one row is its own root; an empty table gives no rows; other columns are
    ignored. Texts are read once, only digests are shuffled, so no key or group is hot.
    """
    values = {name: F.col(f"`{name}`") for name in fields}
    tree = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")), F.lit("0"))
    checked = leaf([(altered or {}).get(name, value) for name, value in values.items()])
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        tree.alias("tree"),
        leaf(list(values.values())).alias("digest"),
        (checked if altered else F.lit(None).cast("string")).alias("checked"),
        F.monotonically_increasing_id().alias("row"),  # tells equal rows apart, fixed by the table
    )
    leaves = stored(_ranked(stored(rows, "merkle-rows"), ["tree"], ["key", "digest", "row"]).drop("row"), "merkle-leaves")
    levels, subroots = _runs(leaves, fanout)

    names = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    upper = stored(_ranked(names, ["tree"], ["name"]), "merkle-trees")
    upper_levels, root = _runs(upper, fanout)
    top = root.select("tree", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    tops = _paths(upper, upper_levels, top, fanout, ["tree", "name", "digest"]).select(
        F.col("name").alias("tree"), "path", F.struct(F.col("digest").alias("subroot"), "root").alias("root")
    )
    found = _paths(leaves, levels, tops, fanout, ["tree", "key", "digest", "checked"])
    return found.select(
        F.col("key").alias(key),
        F.col("digest").alias("leaf"),
        F.coalesce("checked", "digest").alias("checked"),
        "root.subroot",
        "root.root",
        "path",
    )


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its path give."""
    return F.aggregate(path, digest, lambda at, p: F.sha2(F.concat(p["left"], at, p["right"]), 256))


def proof(path: Column) -> Column:
    """A digest of all siblings on a path, from the leaf up and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def report(docs: DataFrame) -> DataFrame:
    """The manifest with proofs, checked against a table in which some texts are altered.

    Where 3 divides the CRC-32 of the decimal id, the text's A-Z are in lower case; rows without
    an id are not altered.
    """
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    text = F.when(tampered, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    found = manifest(docs, {"text": text}).withColumn("folded_root", folded(F.col("checked"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _oracle(levels: int = 6) -> str:
    """The same in SQL, with as many levels written out as 8 ** ``levels`` rows of a language need."""

    def shown(value: str) -> str:
        return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"

    def hashed(values: Sequence[str]) -> str:
        return f"sha256({' || '.join(map(shown, values))})"

    def tree(name: str, groups: str) -> list[str]:
        """Levels of nodes, each with its siblings' digests; a finished tree stays as it is."""
        out = []
        for k in range(levels):
            out.append(
                f"""{name}{k}s AS (
  SELECT {groups}, i, digest, n,
    list(digest) OVER (PARTITION BY {groups}, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run
  FROM {name}{k}
), {name}{k + 1} AS (
  SELECT {groups}, i // 8 AS i, CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(array_to_string(any_value(run), '')) END AS digest,
    (any_value(n) + 7) // 8 AS n
  FROM {name}{k}s GROUP BY {groups}, i // 8
)"""
            )
        return out

    def climb(name: str, groups: str, start: str, columns: str) -> list[str]:
        out, before = [], start
        for k in range(levels):
            left, right = "array_to_string(s.run[1:p.i % 8], '')", "array_to_string(s.run[p.i % 8 + 2:], '')"
            out.append(
                f"""{name}{k}p AS (
  SELECT {columns}, p.i // 8 AS i,
    CASE WHEN s.n = 1 THEN p.proof ELSE p.proof || {left} || {right} END AS proof,
    CASE WHEN s.n = 1 THEN p.folded ELSE sha256({left} || p.folded || {right}) END AS folded
  FROM {before} p JOIN {name}{k}s s ON {' AND '.join(f's.{g} IS NOT DISTINCT FROM p.{g}' for g in groups.split(', '))} AND s.i = p.i
)"""
            )
            before = f"{name}{k}p"
        return out

    crc = (
        "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),"
        " lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
    )
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    plain = list(FIELDS)
    altered = [f"CASE WHEN {crc} % 3 = 0 THEN {lower} ELSE text END" if f == "text" else f for f in plain]
    steps = [
        f"""rows AS (
  SELECT doc_id, lang, {hashed(plain)} AS digest, {hashed(altered)} AS checked FROM documents
), a0 AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, digest) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM rows
)""",
        *tree("a", "lang"),
        f"""b0 AS (
  SELECT 1 AS g, lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM a{levels}
)""",
        *tree("b", "g"),
        "l AS (SELECT doc_id, lang, i, digest AS leaf, '' AS proof, checked AS folded FROM a0)",
        *climb("a", "lang", "l", "p.doc_id, p.lang, p.leaf"),
        f"""u AS (
  SELECT 1 AS g, p.doc_id, p.leaf, b0.digest AS subroot, b0.i, p.proof, p.folded
  FROM a{levels - 1}p p JOIN b0 ON b0.lang IS NOT DISTINCT FROM p.lang
)""",
        *climb("b", "g", "u", "p.g, p.doc_id, p.leaf, p.subroot"),
    ]
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, r.digest AS root, sha256(p.proof) AS proof_sha256, "
        f"p.folded AS folded_root, p.folded = r.digest AS verified FROM b{levels - 1}p p, b{levels} r"
    )


ORACLE = _oracle()
