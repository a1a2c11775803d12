"""Near-duplicate vectors by NN-descent, with exact links."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.llm.components import connected_components
from starmart.llm.shared import Staging

COSINE = 0.9
NEIGHBOURS = 10  # length of a list; see near_duplicates() for lists that are full
TABLES = 4  # random orders that the first lists come from
WINDOW = 256  # rows that are compared with each other there
DESCENTS = 2  # refinements per round
ROUNDS = 4  # at most, until the audit is content
RECALL = 0.98  # that the audit asks for
AUDITED = 1_000  # vectors in components, and as many others, that the audit compares with all
BLOCK = 1_024  # vectors of a component that one task compares with as many others
SLACK = 0.005  # below the threshold, for candidates in single precision

EDGE = "id long, nbr long, sim float"


# --- vectors ----------------------------------------------------------------


def usable(x: Column) -> Column:
    """Whether a vector has a direction: not NULL, no NULL or non-finite component, not all zero."""
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(v.cast("double")))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors of length one, in double and in single precision, as bytes."""
    for batch in batches:
        rows = []
        for x in batch["x"]:
            v = np.asarray(x, np.float64)
            v = v / np.abs(v).max()
            v = v / np.sqrt(v @ v)
            rows.append((v.tobytes(), v.astype(np.float32).tobytes(), len(v)))
        yield pd.DataFrame(rows, columns=["exact", "short", "dim"]).assign(id=batch["id"].to_numpy(), copies=batch["copies"].to_numpy())


def _matrix(values: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _runs(key: np.ndarray) -> list[slice]:
    """The runs of equal keys."""
    edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
    return [slice(a, b) for a, b in zip(edges, edges[1:]) if b > a]


# --- lists ------------------------------------------------------------------


def _best(own: pd.DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each vector the most similar ones of other roots: (id, nbr, sim)."""
    ids, root, x = own["id"].to_numpy(), own["root"].to_numpy(), _matrix(own["short"], np.float32)
    k = min(most, len(ids) - 1)
    if k < 1:
        return ids[:0], ids[:0], np.zeros(0, np.float32)
    sims = np.where(root[:, None] == root[None, :], np.float32(-2), x @ x.T)
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < len(ids) - 1 else np.argsort(-sims, axis=1)[:, :k]
    sims = np.take_along_axis(sims, top, axis=1).ravel()
    other = sims > -2
    return np.repeat(ids, k)[other], ids[top].ravel()[other], sims[other]


def _frame(parts: list) -> pd.DataFrame:
    parts = parts or [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
    return pd.DataFrame({n: np.concatenate(v) for n, v in zip(("id", "nbr", "sim"), zip(*parts))})


def _signed(seed: int, bits: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Add ``cell``, the sides of random planes a vector lies on, and ``along``, its place along a random line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim", sort=False):
                planes = np.random.default_rng([seed, int(dim)]).normal(size=(int(dim), bits + 1)).astype(np.float32)
                at = _matrix(part["short"], np.float32) @ planes
                cell = (at[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                yield part[["id", "root", "short", "dim"]].assign(cell=cell, along=at[:, bits].astype(np.float64))

    return run


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Compare the vectors of each run of up to ``WINDOW`` rows of a cell."""
    for batch in batches:
        parts = []
        for dim in _runs(batch["dim"].to_numpy()):
            for k in range(dim.start, dim.stop, WINDOW):
                parts.append(_best(batch.iloc[k : min(k + WINDOW, dim.stop)], NEIGHBOURS))
        yield _frame(parts)


def first_lists(vectors: DataFrame, n: int, seed: int) -> DataFrame:
    """Neighbours among rows that lie near each other in random orders of the vectors.

    The orders are split by range, on cell and place along a line, so that a cell with a
    large share of all vectors is spread over many tasks.
    """
    bits = max(2, min(40, math.ceil(math.log2(max(2, n) / WINDOW)) + 1))
    lists = None
    for t in range(TABLES):
        keyed = vectors.select("id", "root", "short", "dim").mapInPandas(
            _signed(seed * TABLES + t, bits), "id long, root long, short binary, dim int, cell long, along double"
        )
        found = keyed.repartitionByRange("dim", "cell", "along", "id").sortWithinPartitions("dim", "cell", "along", "id").mapInPandas(
            _windows, EDGE
        )
        lists = found if lists is None else lists.unionByName(found)
    return lists


def shortened(edges: DataFrame) -> DataFrame:
    """The ``NEIGHBOURS`` nearest of each vector, each once."""
    best = Window.partitionBy("id").orderBy(F.desc("sim"), "nbr")
    once = edges.groupBy("id", "nbr").agg(F.max("sim").alias("sim"))
    return once.withColumn("k", F.row_number().over(best)).where(F.col("k") <= NEIGHBOURS).drop("k")


def _met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Compare all neighbours of a vector with each other. Rows come sorted by that vector."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch])
        runs = _runs(batch["hub"].to_numpy())
        rest = batch.iloc[runs[-1]] if runs else None
        yield _frame([_joined(batch.iloc[r]) for r in runs[:-1]])
    if rest is not None and len(rest):
        yield _frame([_joined(rest)])


def _joined(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _best(group, 4)


def descended(lists: DataFrame, vectors: DataFrame) -> DataFrame:
    """One refinement: neighbours of a vector, and those it is a neighbour of, may be neighbours of each other.

    Of those it is a neighbour of it takes the ``NEIGHBOURS`` nearest, so a vector that is
    near very many is no larger group than others; what that misses is left to the
    audit and to ``completed``.
    """
    back = shortened(lists.select(F.col("nbr").alias("id"), F.col("id").alias("nbr"), "sim"))
    around = lists.select(F.col("id").alias("hub"), F.col("nbr").alias("id")).union(back.select("id", "nbr"))
    around = around.union(lists.select("id", "id")).distinct()
    found = around.join(vectors.select("id", "root", "short"), "id").select("hub", "id", "root", "short")
    found = found.repartition("hub").sortWithinPartitions("hub", "id").mapInPandas(_met, EDGE)
    return shortened(lists.unionByName(found))


def within(vectors: DataFrame, rooted: DataFrame) -> DataFrame:
    """``vectors`` with the ``root`` of their component, or their own id."""
    both = vectors.join(rooted.select(F.col("node").alias("id"), "root"), "id", "left")
    return both.withColumn("root", F.coalesce("root", "id"))


def apart(lists: DataFrame, vectors: DataFrame) -> DataFrame:
    """The entries of lists whose two vectors have different roots."""
    of = vectors.select("id", "root")
    both = lists.join(of, "id").join(of.select(F.col("id").alias("nbr"), F.col("root").alias("other")), "nbr")
    return both.where("root <> other").select("id", "nbr", "sim")


def any_full(lists: DataFrame) -> bool:
    """Whether some vector's whole list is near enough, so that others as near may not have had a place."""
    near = lists.where(F.col("sim") >= COSINE - SLACK).groupBy("id").count()
    return not near.where(F.col("count") >= NEIGHBOURS).isEmpty()


# --- links ------------------------------------------------------------------


def _close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            sims = np.array([float(np.frombuffer(a) @ np.frombuffer(b)) for a, b in zip(batch["x"], batch["y"])])
            yield batch.loc[sims >= COSINE, ["a", "b"]]


def close_pairs(lists: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pairs (``a`` < ``b``) from the lists with a cosine in double precision of ``COSINE`` or more."""
    pairs = lists.where(F.col("sim") >= COSINE - SLACK).select(F.least("id", "nbr").alias("a"), F.greatest("id", "nbr").alias("b")).distinct()
    both = pairs.join(vectors.select(F.col("id").alias("a"), F.col("exact").alias("x")), "a")
    both = both.join(vectors.select(F.col("id").alias("b"), F.col("exact").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInPandas(_close, "a long, b long")


def _bridges(group: pd.DataFrame) -> pd.DataFrame:
    """The pairs of different roots that some link between two blocks joins, each once."""
    mine, lo, hi = (group[c].to_numpy() for c in ("mine", "lo", "hi"))
    x, root = _matrix(group["exact"], np.float64), group["root"].to_numpy()
    left, right = np.flatnonzero(mine == lo), np.flatnonzero(mine == hi)
    pairs = [np.zeros((0, 2), np.int64)]
    for k in range(0, len(left), BLOCK):
        rows = left[k : k + BLOCK]
        a, b = np.nonzero((x[rows] @ x[right].T >= COSINE) & (root[rows][:, None] != root[right][None, :]))
        pairs.append(np.unique(np.sort(np.stack([root[rows][a], root[right][b]], axis=1), axis=1), axis=0))
    return pd.DataFrame(np.unique(np.concatenate(pairs), axis=0), columns=["a", "b"])


def bridged(vectors: DataFrame, n: int) -> DataFrame:
    """Pairs (``a`` < ``b``) of roots that some link joins, from an exact comparison of all vectors, block by block.

    The work grows with the square of the table, so this is for what the lists have not found.
    """
    blocks = max(1, math.ceil(n / (4 * BLOCK)))
    dealt = vectors.select("dim", "root", "exact", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("mine"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    paired = paired.select("dim", "root", "exact", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    return paired.groupBy("dim", "lo", "hi").applyInPandas(_bridges, "a long, b long").distinct()


def _counted(group: pd.DataFrame) -> pd.DataFrame:
    """Links within components, or between two blocks of one; every vector counts the others, and their copies."""
    parts = []
    order = np.argsort(group["root"].to_numpy(), kind="stable")
    group = group.iloc[order]
    for r in _runs(group["root"].to_numpy()):
        own = group.iloc[r]
        mine, lo, hi = (own[c].to_numpy() for c in ("mine", "lo", "hi"))
        x, copies, ids = _matrix(own["exact"], np.float64), own["copies"].to_numpy(), own["id"].to_numpy()
        left, right = mine == lo, mine == hi
        near = x[left] @ x[right].T >= COSINE
        if lo[0] == hi[0]:
            np.fill_diagonal(near, False)
            parts.append((ids, near @ copies, near.sum(axis=1)))
        else:
            parts.append((ids[left], near @ copies[right], near.sum(axis=1)))
            parts.append((ids[right], near.T @ copies[left], near.sum(axis=0)))
    return pd.DataFrame({name: np.concatenate(values) for name, values in zip(("id", "links", "others"), zip(*parts))})


def completed(rooted: DataFrame, vectors: DataFrame, staging: Staging) -> DataFrame:
    """(``id``, ``root``, ``size``, ``links``, ``others``): each member's links to all of its component, counted exactly.

    ``links`` counts the copies of the linked vectors, ``others`` the vectors, ``size`` those of the component.

    Lists are enlarged to the whole component: components are cut into blocks of about ``BLOCK`` vectors, and
    every two blocks of one are compared in a task, which returns a count for each of
    their vectors and no pairs. Components smaller than a block share tasks.
    """
    sizes = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = staging.keep(
        rooted.join(sizes, "root")
        .select(F.col("node").alias("id"), "root", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("mine"), blocks.alias("blocks"), "size")
        .join(vectors.select("id", "exact", "copies"), "id"),
        "members",
    )
    total = members.count()
    shared = F.pmod(F.xxhash64("root"), F.lit(max(1, total // BLOCK)))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = members.select("*", other).select(
        "id", "root", "mine", "exact", "copies", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
        F.when(F.col("blocks") == 1, shared).otherwise(F.col("root")).alias("task"), (F.col("blocks") == 1).alias("small"),
    )
    counted = paired.groupBy("small", "task", "lo", "hi").applyInPandas(_counted, "id long, links long, others long")
    links = counted.groupBy("id").agg(F.sum("links").alias("links"), F.sum("others").alias("others"))
    return staging.keep(members.select("id", "root", "size").join(links, "id"), "completed")


def _sampled(found: DataFrame, vectors: DataFrame) -> DataFrame:
    """The audit's vectors: (``id``, ``exact``, ``dim``, ``others``, ``weight``).

    Components are told apart by the power of two below their size, and each such class gives as many
    vectors, ``AUDITED`` together; vectors without a component give ``AUDITED``. Within a class those
    with the smallest hashes are taken. ``weight`` is how many of its class a vector stands for.
    """
    known = found.select("id", "others", F.floor(F.log2("size")).cast("int").alias("class"))
    each = vectors.select("id").join(known, "id", "left").select("id", F.coalesce("class", F.lit(0)).alias("class"), F.coalesce("others", F.lit(0)).alias("others"))
    classes = {r["class"]: r["count"] for r in each.groupBy("class").count().collect()}
    grouped = max(1, len(classes) - (0 in classes))
    chosen = None
    for c, n in classes.items():
        most = AUDITED if c == 0 else max(1, AUDITED // grouped)
        own = each.where(F.col("class") == c).orderBy(F.xxhash64("id"), "id").limit(most).withColumn("weight", F.lit(n / min(n, most)))
        chosen = own if chosen is None else chosen.unionByName(own)
    return None if chosen is None else chosen.join(vectors.select("id", "exact", "dim"), "id")


def recall(found: DataFrame, vectors: DataFrame) -> float:
    """The least share of links that ``found`` has, over classes of vectors with a similar number of links.

    The vectors of ``_sampled`` are compared with all. Each has the share of its own links that
    were found, whatever their copies, and a class (1, 2 or 3, 4 to 7 ... links) the weighted mean of its
    vectors' shares. So a large group cannot make up for small ones.
    """
    sampled = _sampled(found, vectors)
    if sampled is None:
        return 1.0
    chosen = sampled.toPandas()
    asked = {int(d): (own["id"].to_numpy(), _matrix(own["exact"], np.float64)) for d, own in chosen.groupby("dim")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, own in batch.groupby("dim"):
                if dim not in asked:
                    continue
                ids, x = asked[dim]
                near = x @ _matrix(own["exact"], np.float64).T >= COSINE
                near &= ids[:, None] != own["id"].to_numpy()[None, :]
                yield pd.DataFrame({"id": ids, "n": near.sum(axis=1)})

    true = vectors.select("id", "exact", "dim").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).where("n > 0").toPandas()
    both = true.merge(chosen[["id", "others", "weight"]], on="id")
    if both.empty:
        return 1.0
    both["share"] = both["weight"] * np.minimum(1, both["others"] / both["n"])
    sums = both.groupby(np.floor(np.log2(both["n"])))[["share", "weight"]].sum()
    return float((sums["share"] / sums["weight"]).min())


def near_duplicates(table: DataFrame, staging: Staging | None = None) -> DataFrame:
    """(``vec_id``, ``n_links``, ``component_id``, ``kept``), one row per row of ``table``.

    Compared are the ``embedding``s, whatever the other columns hold. Equal vectors are merged first and
    linked to each other; NULL, zero and vectors with NULL or non-finite components link with
    nothing; vectors of different lengths are not compared. Links have a cosine of
    ``COSINE`` or more in double precision. ``component_id`` is the smallest vec_id that links reach. Rows
    that repeat a vec_id stay, each linked to the others if the vectors are equal; a
    row with NULL vec_id counts as a link of others, names no component and is not kept. An empty table gives no rows.

    Lists of nearest neighbours begin in random orders and are refined by NN-descent. What is
    near enough makes components, and within them links are counted exactly
    (``completed``). An audit compares a bounded sample with all vectors; while vectors of some number
    of links have less than ``RECALL`` of them (``recall``), there is another round, with new random orders.

    A list in which every neighbour is near enough is full, and may lack others. The members of
    its component need no place, so the next round's lists hold only neighbours of other
    components; such rounds go on until one finds no more links. If ``ROUNDS`` end without that, or
    with an audit that fails, all vectors are compared exactly (``bridged``).
    """
    staging = staging or Staging(table.sparkSession)
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(F.col("embedding")), x).alias("x"))
    rows = staging.keep(rows.withColumn("key", F.xxhash64("x")), "rows")
    merged = rows.where("x IS NOT NULL").groupBy("key", "x").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    merged = staging.keep(merged.withColumn("id", F.monotonically_increasing_id()), "merged")
    vectors = staging.keep(
        merged.select("id", "x", "copies").mapInPandas(_unit, "exact binary, short binary, dim int, id long, copies long"), "vectors"
    )
    n, lists, links, rooted, whole = vectors.count(), None, None, None, False
    placed = vectors.withColumn("root", F.col("id"))
    for k in range(ROUNDS):
        new = first_lists(placed, n, k)
        lists = staging.keep(shortened(new if lists is None else lists.unionByName(new)), "lists")
        for _ in range(DESCENTS):
            lists = staging.keep(descended(lists, placed), "lists")
        more = staging.keep(close_pairs(lists, vectors), "pairs")
        settled = more.isEmpty()
        if rooted is None or not settled:
            links = more if links is None else links.union(more)
            rooted = staging.keep(connected_components(links, staging), "rooted")
        if settled or not any_full(lists):
            done = completed(rooted, vectors, staging)
            whole = recall(done, vectors) >= RECALL
        if whole:
            break
        placed = staging.keep(within(vectors, rooted), "placed")
        lists = apart(lists, placed)
    if not whole:
        rooted = staging.keep(connected_components(links.union(bridged(placed, n)), staging), "rooted")
        done = completed(rooted, vectors, staging)
    named = merged.select("id", "least", "copies", "key", "x").join(done, "id", "left")
    own = F.coalesce("root", "id")
    named = named.withColumn("own", own)
    first = named.groupBy("own").agg(F.min("least").alias("component_id"))
    named = staging.keep(named.join(first, "own").select("key", "x", "copies", F.coalesce("links", F.lit(0)).alias("links"), "component_id"), "named")
    key = [F.col("r.key") == F.col("m.key"), F.col("r.x") == F.col("m.x")]
    out = rows.alias("r").join(named.alias("m"), key, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
