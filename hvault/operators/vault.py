"""Hub, link (+ link satellite) and hub-satellite loaders.

Each loader is a function from (current table, staged batch) to the new
table. The target is split once by the batch's keys: rows of untouched keys
pass through unchanged (a semi / anti join against the batch key set, which
is broadcast when its size is proven small, so the large target is never
shuffled for it), and only the touched keys are recomputed. When the key set
is known to be large, target and batch rows are exchanged once together by
key instead, and a window tells the touched keys. Exchanges move hash columns
packed (``pack``: 16 bytes instead of 32 characters).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hvault.functions.keys import open_end, pack, packed, ts_lit, unpack, unpacked
from hvault.operators.intervals import REFERENCE, STRICT, merge_intervals
from hvault.operators.segmented import merge_intervals_segmented, next_value_segmented
from hvault.plans.sizing import broadcast_if_small, shuffled

FROM = "effective_from_dttm"
TO = "effective_to_dttm"


def split_by_keys(target: DataFrame, keys: DataFrame, key: str, small: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of ``target`` whose key is in ``keys``, the other rows).

    ``small`` is a proven bound on the key set (e.g. the staged batch's row
    count); without it the key set is counted. A small key set is broadcast,
    so the target is filtered where it lies, without a shuffle.
    """
    k = keys.select(key)
    if small is None:
        k = broadcast_if_small(k.distinct())
    elif small:
        # the bound is on rows, so duplicates need no exchange to be removed
        k = F.broadcast(k)
    else:
        k = shuffled(k.distinct())
    return target.join(k, key, "left_semi"), target.join(k, key, "left_anti")


def split_hot(df: DataFrame, hot: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the keys in ``hot``, the other rows, NULL keys included). There are at most rows / bound hot keys; they are
    broadcast when counted to be few."""
    k = broadcast_if_small(hot.select(key), counted=hot)
    return df.join(k, key, "left_semi"), df.join(k, key, "left_anti")


def by_heat(df: DataFrame, hot_keys: bool | DataFrame, key: str) -> list[tuple[DataFrame, bool]]:
    """``df`` in parts, each with whether its keys are hot."""
    if not isinstance(hot_keys, DataFrame):
        return [(df, hot_keys)]
    hot, rest = split_hot(df, hot_keys, key)
    return [(rest, False), (hot, True)]


def upsert_interval(
    target: DataFrame,
    rows: DataFrame,
    key: str,
    start: str = FROM,
    update: Sequence[str] = (TO,),
    small: bool | None = None,
) -> DataFrame:
    """Upsert on (key, start): where (key, start) exists only the ``update``
    columns of the existing row change; other rows are inserted whole
    (columns missing in ``rows`` are NULL).

    Only keys present in ``rows`` are rewritten. Existing and new rows of a
    (key, start) meet in one aggregate (one exchange of both sides together)
    instead of a full outer join.
    """
    touched, untouched = split_by_keys(target, rows, key, small)
    cols = [c for c in target.columns if c not in (key, start)]
    typed = [F.col(c) if c in rows.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in cols]
    t = touched.select(key, start, F.lit(None).alias("_new"), F.struct(*cols).alias("_old"))
    r = rows.select(key, start, F.struct(*typed).alias("_new"), F.lit(None).alias("_old"))
    g = t.unionByName(r, allowMissingColumns=True).groupBy(key, start).agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
    pick = lambda c: (
        F.when(F.col("_old").isNull(), F.col(f"_new.{c}"))
        .when(F.col("_new").isNull(), F.col(f"_old.{c}"))
        .otherwise(F.col(f"_new.{c}") if c in update else F.col(f"_old.{c}"))
    )
    return untouched.unionByName(g.select(key, start, *[pick(c).alias(c) for c in cols]).select(*target.columns))


def _nothing_stored(target: DataFrame, small: bool | None) -> bool:
    """Does a large batch (others are not asked about) meet an empty target, so that there is nothing to split?"""
    return small is False and target.isEmpty()


def _known_keys(table: DataFrame, cand: DataFrame, key: str, small: bool | None) -> DataFrame:
    """Keys of ``table`` to be left out of ``cand``: all of them when the candidates are many (both sides are exchanged
    for the anti join anyway), else those among the candidates."""
    if small is False:
        return shuffled(table.select(key))
    existing, _ = split_by_keys(table.select(key), cand, key, small)
    return F.broadcast(existing) if small else existing


# --- hubs ------------------------------------------------------------------


def load_hub(
    hub: DataFrame,
    candidates: Sequence[DataFrame],
    key: str,
    id_col: str,
    src_cd: str,
    load_ts: str,
    small: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Insert keys not yet in the hub. Returns (new hub, inserted rows).

    The union of the candidate (key, id) pairs is reduced to one row per key
    with the smallest id, so ids that hash alike ('a', 'A ') cannot insert one
    key twice. The aggregate is partial (map-side) before its shuffle.
    """
    cand = reduce(DataFrame.unionByName, [c.select(key, id_col) for c in candidates])
    cand = packed(cand.filter(F.col(key).isNotNull()), key).groupBy(key).agg(F.min(id_col).alias(id_col))
    new = unpacked(cand.join(_known_keys(packed(hub, key), cand, key, small), key, "left_anti"), key)
    extra = [c for c in hub.columns if c not in (key, id_col, "load_dttm", "src_cd")]
    new = new.select(
        key,
        id_col,
        *[F.lit(None).cast(hub.schema[c].dataType).alias(c) for c in extra],
        ts_lit(load_ts).alias("load_dttm"),
        F.lit(src_cd).alias("src_cd"),
    ).select(*hub.columns)
    return hub.unionByName(new), new


# --- links and link satellites ---------------------------------------------


@dataclass
class LinkLoad:
    link: DataFrame
    lsat: DataFrame
    inserted_links: DataFrame
    loaded: bool  # False when the reference rules stop early


def _insert_links(link: DataFrame, rows: DataFrame, key: str, hub_keys: Sequence[str], src_cd: str, load_ts: str, small: bool | None) -> DataFrame:
    cand = packed(rows.select(key, *hub_keys), key, *hub_keys).groupBy(key).agg(*[F.min(h).alias(h) for h in hub_keys])
    new = cand.join(_known_keys(packed(link, key), cand, key, small), key, "left_anti")
    return unpacked(new, key, *hub_keys).select(
        key, *hub_keys, ts_lit(load_ts).alias("load_dttm"), F.lit(src_cd).alias("src_cd")
    )


def load_link(
    link: DataFrame,
    lsat: DataFrame,
    staged: DataFrame,
    key: str,
    hub_keys: Sequence[str],
    src_cd: str,
    version: int,
    load_ts: str,
    mode: str = STRICT,
    small: bool | None = None,
    hot_keys: bool | DataFrame = False,
    partitions: int | None = None,
    placed: DataFrame | None = None,
) -> LinkLoad:
    """Load a link and its validity satellite from staged rows
    (key, hub keys..., create_dttm, delete_dttm as timestamps).

    reference: the batch is the staged rows plus the open satellite rows of
    their keys; nothing happens when every batch key already has an open row;
    merged islands are upserted on (key, start), updating only the end.
    strict: all satellite rows of the touched keys are merged again with the
    batch (an explicit end replaces the open end of the same start) and replace
    the old rows; rows that do not change keep their version.
    ``hot_keys`` (all keys, or a frame that names the hot ones): the interval
    merge of these keys runs as a segmented scan (no window over a whole key),
    the other keys keep the window; the per-start step is a partial aggregate
    in both paths.
    ``placed``: the staged rows exchanged by the packed key (``staging.placed``);
    links and first loads take these and make no exchange of their own.
    """
    def merge(df, m, hot, **kw):
        if hot:
            return merge_intervals_segmented(df, key, "create_dttm", "delete_dttm", m, partitions, **kw)
        return merge_intervals(df, key, "create_dttm", "delete_dttm", m, **kw)

    staged = staged.filter(F.col(key).isNotNull())
    first = _nothing_stored(lsat, small)
    together = mode != REFERENCE and hot_keys is False and small is False and not first
    placed = None if placed is None else placed.filter(F.col(key).isNotNull())
    lies = first and hot_keys is False and placed is not None
    if mode == REFERENCE:
        plain = hot_keys is False
        stored, came = (packed(df, key) for df in (lsat, staged)) if plain else (lsat, staged)
        touched, untouched = (stored, stored) if first else split_by_keys(stored, came, key, small)
        open_rows = touched.filter(F.col(TO) == open_end())
        batch = came.select(key, *hub_keys, "create_dttm", "delete_dttm").unionByName(
            open_rows.select(
                key,
                *[F.lit(None).cast("string").alias(h) for h in hub_keys],
                F.col(FROM).alias("create_dttm"),
                F.col(TO).alias("delete_dttm"),
            )
        )
        # rows of the batch that came from the satellite have an open row by definition
        known = stored.filter(F.col(TO) == open_end()).select(key)
        unknown = came if first else came.select(key).join(shuffled(known) if small is False else known, key, "left_anti")
        if unknown.isEmpty():
            return LinkLoad(link, lsat, link.limit(0), False)
        new_links = _insert_links(link, staged if placed is None else placed, key, hub_keys, src_cd, load_ts, small)
        # one exchange by key: equal rows and islands reuse it
        if lies:
            batch = packed(placed.select(key, *hub_keys, "create_dttm", "delete_dttm"), key, *hub_keys).distinct()
        else:
            batch = (packed(batch, *hub_keys).repartition(key) if plain else batch).distinct()
        merged = reduce(DataFrame.unionByName, [merge(part, REFERENCE, hot) for part, hot in by_heat(batch, hot_keys, key)]).select(
            key, F.col("create_dttm").alias(FROM), F.coalesce("delete_dttm", open_end()).alias("_new_to")
        )
        if first:
            up = merged.select(key, F.lit(version).cast("long").alias("version_id"), FROM, F.col("_new_to").alias(TO), F.lit(src_cd).alias("src_cd"))
            return LinkLoad(link.unionByName(new_links), lsat.unionByName(unpacked(up, key) if plain else up), new_links, True)
        t = touched.alias("t")
        m = merged.alias("m")
        up = t.join(m, [key, FROM], "full_outer").select(
            key,
            F.coalesce(F.col("t.version_id"), F.lit(version).cast("long")).alias("version_id"),
            F.col(FROM),
            F.coalesce(F.col("m._new_to"), F.col(f"t.{TO}")).alias(TO),
            F.coalesce(F.col("t.src_cd"), F.lit(src_cd)).alias("src_cd"),
        )
        rows = untouched.unionByName(up)
        return LinkLoad(link.unionByName(new_links), unpacked(rows, key) if plain else rows, new_links, True)

    if not together:
        touched, untouched = (lsat, lsat) if first else split_by_keys(lsat, staged, key, small)
    new_links = _insert_links(link, staged if placed is None else placed, key, hub_keys, src_cd, load_ts, small)
    # One exchange on the key: per-start ends, islands and the island's first
    # old row (to keep unchanged versions) all reuse that partitioning.
    ts_type = lsat.schema[TO].dataType
    if together:
        new = staged.select(
            key, F.lit(None).cast("long").alias("version_id"), F.col("create_dttm").alias(FROM), F.col("delete_dttm").alias(TO),
            F.lit(None).cast("string").alias("src_cd"), F.lit(True).alias("_new"),
        )
        both = new.unionByName(lsat.filter(F.col(key).isNotNull()).withColumn("_new", F.lit(False)))
        both = packed(both, key).repartition(key).withColumn("_touched", F.max("_new").over(Window.partitionBy(key)))
        untouched = lsat.filter(F.col(key).isNull()).unionByName(unpacked(both.filter(~F.col("_touched")).select(*lsat.columns), key))
        was = lambda c: F.when(~F.col("_new"), F.col(c))
        rows = both.filter(F.col("_touched")).select(
            key,
            F.col(FROM).alias("create_dttm"),
            F.when(F.col("_new"), F.col(TO)).otherwise(F.nullif(F.col(TO), open_end())).alias("delete_dttm"),
            was(TO).alias("_old_to"),
            was("version_id").alias("_old_v"),
            was("src_cd").alias("_old_src"),
        )
    else:
        rows = (placed if lies else staged).select(
            key, "create_dttm", "delete_dttm", F.lit(None).cast(ts_type).alias("_old_to"), F.lit(None).cast("long").alias("_old_v"), F.lit(None).cast("string").alias("_old_src")
        )
        # a union would lose the place of the rows
        rows = rows if lies else rows.unionByName(
            touched.select(
                key,
                F.col(FROM).alias("create_dttm"),
                F.nullif(F.col(TO), open_end()).alias("delete_dttm"),
                F.col(TO).alias("_old_to"),
                F.col("version_id").alias("_old_v"),
                F.col("src_cd").alias("_old_src"),
            )
        )

    def islands(part: DataFrame, hot: bool) -> DataFrame:
        if not (hot or together):
            part = packed(part, key) if lies else packed(part, key).repartition(key)
        part = part.filter(F.col("create_dttm").isNotNull())
        per_start = part.groupBy(key, "create_dttm").agg(
            F.min("delete_dttm").alias("delete_dttm"), F.max(F.struct("_old_to", "_old_v", "_old_src")).alias("_old")
        )
        islands = merge(per_start, STRICT, hot, first_of=["_old"])
        return islands if hot else unpacked(islands, key)

    merged = reduce(DataFrame.unionByName, [islands(part, hot) for part, hot in by_heat(rows, hot_keys, key)])
    to = F.coalesce("delete_dttm", open_end())
    same = F.col("_first._old._old_to") == to
    replaced = merged.select(
        key,
        F.when(same, F.col("_first._old._old_v")).otherwise(F.lit(version).cast("long")).alias("version_id"),
        F.col("create_dttm").alias(FROM),
        to.alias(TO),
        F.when(same, F.col("_first._old._old_src")).otherwise(F.lit(src_cd)).alias("src_cd"),
    )
    return LinkLoad(link.unionByName(new_links), untouched.unionByName(replaced), new_links, True)


# --- hub satellites (SCD2) -------------------------------------------------


def load_hsat(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    hash_col: str,
    attrs: Sequence[str],
    src_cd: str,
    version: int,
    mode: str = STRICT,
    small: bool | None = None,
    hot_keys: bool | DataFrame = False,
    partitions: int | None = None,
    placed: bool = False,
) -> DataFrame:
    """SCD2 load of a hub satellite. ``batch``: key, hash, create_dttm,
    delete_dttm, attributes, last_update (typed).

    Both modes first keep one batch row per (key, start): the latest
    last_update, then the largest hash.

    reference: target rows of the batch's keys from the batch's first start on
    are merged with the batch; batch rows (and open target rows starting
    before the batch's last start) end at their explicit deletion or else at
    the next start; the result is upserted on (key, start), updating only the
    end and the version of existing rows (their attributes stay).
    strict: every row of a touched key ends at least(own explicit end, next
    start), a batch row replaces the target row of the same start (new
    attributes), and unchanged rows keep their version.

    Plan: the batch rows and the touched target rows are unioned and
    exchanged once by key; the per-start choice, the shadowing of target rows
    by batch rows of the same start and the next start are windows over that
    one partitioning and sort order. Untouched target rows pass through a
    broadcast anti join (the batch key set is proven small) without a shuffle;
    a large key set sends them through the same exchange, where rows of keys
    without a batch row are told by the window and stay as they are.
    ``hot_keys``: True avoids windows over a whole key for all keys; a frame of
    keys does so for these only, and the other keys keep the plan above.
    ``placed``: the target is empty and the batch rows are exchanged by the packed
    key (``staging.placed``), so that the load makes no exchange of its own.
    """
    if isinstance(hot_keys, DataFrame):
        parts = zip(by_heat(target, hot_keys, key), by_heat(batch, hot_keys, key))
        loads = [load_hsat(t, b, key, hash_col, attrs, src_cd, version, mode, small, hot, partitions) for (t, hot), (b, _) in parts]
        return reduce(DataFrame.unionByName, loads)
    out_cols = [key, "version_id", hash_col, FROM, TO, "src_cd", *attrs]
    b = batch.filter(F.col("create_dttm").isNotNull())
    first = placed or _nothing_stored(target, small)
    together = not hot_keys and small is False and not first
    if first:
        touched, untouched = target, target
    elif together:
        # NULL keys never touch a stored row
        touched, untouched = target.filter(F.col(key).isNotNull()), target.filter(F.col(key).isNull())
    else:
        touched, untouched = split_by_keys(target, b, key, small)
    ts_type = target.schema[FROM].dataType
    new_rows = b.select(
        key,
        F.col("create_dttm").alias(FROM),
        F.lit(0).alias("_prio"),
        F.col("delete_dttm").alias("_explicit"),
        hash_col,
        *attrs,
        F.lit(src_cd).alias("src_cd"),
        F.col("last_update").alias("_lu"),
        F.lit(None).cast("long").alias("_old_v"),
    )
    old_rows = touched.select(
        key,
        FROM,
        F.lit(1).alias("_prio"),
        F.col(TO).alias("_explicit"),
        hash_col,
        *attrs,
        "src_cd",
        F.lit(None).cast(ts_type).alias("_lu"),
        F.col("version_id").alias("_old_v"),
    )
    # a union would lose the place of the rows
    u = new_rows if placed else new_rows.unionByName(old_rows)
    if placed:
        u = packed(u, key)
    elif not hot_keys:
        # the hash is text again before the windows, whose order goes by it; the key stays packed up to the result
        u = unpacked(packed(u, key, hash_col).repartition(key), hash_col)
    # told apart behind the exchange, which moves one end a row
    u = u.withColumns({"_del": F.when(F.col("_prio") == 0, F.col("_explicit")), "_old_to": F.when(F.col("_prio") == 1, F.col("_explicit"))})
    old = F.struct(F.col(hash_col).alias("h"), *[F.col(a).alias(f"a{i}") for i, a in enumerate(attrs)], F.col("src_cd").alias("src"))
    if not hot_keys:
        order = [F.col(FROM).asc(), F.col("_prio").asc(), F.col("_lu").desc_nulls_last(), F.col(hash_col).desc_nulls_last(), F.col("_del").desc_nulls_last()]
        order += [F.col(a).desc_nulls_last() for a in attrs]
        w_first = Window.partitionBy(key).orderBy(*order)
        w_start = Window.partitionBy(key, FROM)
        w_key = Window.partitionBy(key)
        u = u.select(
            "*",
            F.lag(FROM).over(w_first).alias("_prev_from"),
            F.max(F.when(F.col("_prio") == 1, old)).over(w_start).alias("_old"),
            F.min(F.when(F.col("_prio") == 0, F.col(FROM))).over(w_key).alias("_min"),
            F.max(F.when(F.col("_prio") == 0, F.col(FROM))).over(w_key).alias("_max"),
        )
        kept = u.filter(F.col("_min").isNull() | F.col("_prev_from").isNull() | (F.col("_prev_from") != F.col(FROM)))
        kept = kept.withColumn("_next", F.lead(FROM).over(Window.partitionBy(key).orderBy(F.col(FROM).asc())))
    else:
        # Hot keys: no window over a whole key. The row kept for a (key, start)
        # is a partial aggregate (max over a struct in the window's order:
        # batch first, then latest update, largest hash, deletion, attributes);
        # the batch's first/last start per key is an aggregate joined back; the
        # next start is a segmented scan over range-partitioned (key, start).
        payload = ["_prio", "_explicit", hash_col, *attrs, "src_cd", "_old_v", "_old_to"]
        rank = F.struct(
            (-F.col("_prio")).alias("_w"), F.col("_lu").alias("_r1"), F.col(hash_col).alias("_r2"), F.col("_del").alias("_r3"),
            *[F.col(a).alias(f"_r{4 + i}") for i, a in enumerate(attrs)],
            F.struct(*[F.col(c) for c in payload]).alias("_p"),
        )
        per_start = u.groupBy(key, FROM).agg(F.max(rank).alias("_best"), F.max(F.when(F.col("_prio") == 1, old)).alias("_old"))
        bounds = b.groupBy(key).agg(F.min("create_dttm").alias("_min"), F.max("create_dttm").alias("_max"))
        kept = per_start.select(key, FROM, "_best._p.*", "_old").join(bounds, key, "left")
        kept = next_value_segmented(kept, key, [FROM], FROM, "_next", partitions)
    next_from = F.col("_next")
    v = F.lit(version).cast("long")
    is_new = F.col("_prio") == 0
    if mode == REFERENCE:
        mark = is_new | ((F.col(FROM) >= F.col("_min")) & (F.col("_explicit") == open_end()) & (F.col(FROM) < F.col("_max")))
        new_to = F.coalesce(F.nullif(F.col("_explicit"), open_end()), next_from, open_end())
        has_old = is_new & F.col("_old").isNotNull()
        res = kept.select(
            key,
            F.when(mark, v).otherwise(F.col("_old_v")).alias("version_id"),
            F.when(has_old, F.col("_old.h")).otherwise(F.col(hash_col)).alias(hash_col),
            FROM,
            F.when(mark, new_to).otherwise(F.col("_explicit")).alias(TO),
            F.when(has_old, F.col("_old.src")).otherwise(F.col("src_cd")).alias("src_cd"),
            *[F.when(has_old, F.col(f"_old.a{i}")).otherwise(F.col(a)).alias(a) for i, a in enumerate(attrs)],
        )
    else:
        end = F.least(F.coalesce(F.col("_explicit"), open_end()), F.coalesce(next_from, open_end()))
        res = kept.withColumn("_end", end).select(
            key,
            F.when(F.col("_min").isNull() | (~is_new & (F.col("_old_to") == F.col("_end"))), F.col("_old_v")).otherwise(v).alias("version_id"),
            hash_col,
            FROM,
            F.when(F.col("_min").isNull(), F.col("_explicit")).otherwise(F.col("_end")).alias(TO),
            "src_cd",
            *attrs,
        )
    res = res if hot_keys else unpacked(res, key)
    return untouched.select(*out_cols).unionByName(res.select(*out_cols))
