"""Golden records: one row for each cluster of records, each field by its own rule of survival.

Each partition keeps, for each cluster, the records that win a slot: of every field, within each trust (name, email, address), of
the segment, and of the balance within the chosen segment and beside it. No other record can win in the end, as within one trust
the fresh come before the stale wherever the later come before the earlier. Counts of records and of stale ones go along with
what is kept. Only these survivors, a bounded number of each cluster and partition, reach the grouped pandas function.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Sources by falling trust.
SOURCES = ("partner", "store", "web", "crm")
#: Clusters of more records than this, and than one in so many of all records, are pruned where they lie. There can't be more such
#: clusters than PARTS, which bounds what is broadcast.
LARGE, PARTS = 1000, 1000
#: Partitions of which a large cluster's survivors are pruned together, level by level; clusters in a group of the pandas function.
FAN, GROUP = 64, 2000
#: Rows that a task holds before it prunes them; survivors beyond half of it leave as they are.
HELD = 200_000
#: The place of a null time before all others.
NEVER = -(1 << 63)

_ROW = "cluster long, clustered boolean, client long, known boolean, trust int, name string, email string, city string, nation int, segment string, balance double, chosen boolean, stale boolean, tie long"
_KEPT = _ROW + ", at long, n long, n_stale long, part int"
_GOLDEN = (
    "cluster_id long, n_records long, n_stale long, name string, email string, segment string, city string, nation_id int, balance_cents long,"
    " name_from long, email_from long, segment_from long, balance_from long, address_from long"
)


def _text(name: str) -> Column:
    """A field's text, null where there is nothing but white space."""
    c = F.col(name).cast("string")
    return F.when(c.rlike(r"[^\x20\x09-\x0D]"), c)


def _cleaned(clients: DataFrame, sources: Sequence[str]) -> DataFrame:
    source, balance, texts = _text("source"), F.col("balance").cast("double"), ("name", "email", "city", "segment")
    finite = F.when(~F.isnan(balance) & (F.abs(balance) < float("inf")), balance)
    key = F.coalesce(F.col("master_id"), F.col("client_id")).cast("long")
    rows = clients.select(
        key.alias("key"), F.col("client_id").cast("long").alias("client_id"), F.coalesce(*[F.when(source == s, len(sources) - k) for k, s in enumerate(sources)], F.lit(0)).alias("trust"),
        F.col("updated_at"), *[_text(c).alias(c) for c in texts], F.col("nation_id").cast("int").alias("nation"), finite.alias("balance"),
    )
    return rows.withColumn("tie", F.xxhash64(*texts, "nation", "balance"))


def _recent() -> Column:
    """The larger, the earlier in the order of the latest; null times and null clients last."""
    return F.struct(F.col("updated_at").alias("t"), F.col("trust").alias("s"), F.col("client_id").isNotNull().alias("k"), F.bitwise_not("client_id").alias("c"), F.col("tie").alias("h"))


def golden(clients: DataFrame, sources: Sequence[str] = SOURCES, days: int = 30) -> DataFrame:
    """One record for each cluster (master_id, or client_id where that is null; both null make a cluster of their own).

    Strings of white space alone count as null, others stay as they are; so does a balance that is no finite number. A record is
    stale if it has no time or one more than `days` times 24 hours before its cluster's latest. RECENT: latest first, then trust,
    then the smaller client_id (null last). TRUSTED: fresh first, then trust, then RECENT; sources that aren't listed come last.
    Each field takes the first value that isn't null: segment by RECENT, email by TRUSTED, name by most code points, then TRUSTED,
    balance from the chosen segment first, then RECENT; city and nation_id come from one record, that with most of both, then by
    TRUSTED. The columns *_from have the client_id of the record that supplied the value, null where there is none. Records that
    agree in all of RECENT, as repeated rows do, are ordered by a hash of their fields. An empty table gives no rows; other
    columns are ignored.

    A first aggregation finds each cluster's latest time and segment (combined on the map side). Clusters with more than one in
    PARTS of all records get theirs by broadcast, so that their records are pruned where they lie, then level by level, FAN
    partitions at a time; the others by a join on the cluster. No task sees all records of a large cluster.
    """
    rows = _cleaned(clients, sources)
    first = common.stored(rows.groupBy("key").agg(
        F.count("*").alias("size"), F.max("updated_at").alias("latest"), F.max_by("segment", F.when(F.col("segment").isNotNull(), _recent())).alias("main"),
    ))
    clusters, records = first.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    most = max(LARGE, records // PARTS)
    large = F.broadcast(first.where(F.col("size") > most).select(F.col("key").alias("large_key"), "latest", "main", F.lit(True).alias("is_large")))  # PARTS rows at most
    marked = rows.join(large, F.col("key").eqNullSafe(F.col("large_key")), "left").drop("large_key")
    others = first.where(F.col("size") <= most).select(F.col("key").alias("other_key"), "latest", "main")
    light = marked.where("is_large is null").drop("latest", "main").join(others, F.col("key").eqNullSafe(F.col("other_key"))).drop("other_key")

    def told(df: DataFrame) -> DataFrame:
        stale = F.col("updated_at").isNull() | (F.col("updated_at") < F.col("latest") - F.expr(f"INTERVAL {24 * days} HOURS"))
        return df.select(
            F.coalesce("key", F.lit(0)).alias("cluster"), F.col("key").isNotNull().alias("clustered"), F.coalesce("client_id", F.lit(0)).alias("client"), F.col("client_id").isNotNull().alias("known"),
            "trust", "name", "email", "city", "nation", "segment", "balance", (F.col("segment") == F.col("main")).eqNullSafe(F.lit(True)).alias("chosen"), stale.alias("stale"), "tie", F.col("updated_at").alias("at"),
        )

    def pruned(df: DataFrame) -> DataFrame:
        return df.mapInArrow(common.lean(_prune), _KEPT)

    heavy = pruned(told(marked.where("is_large")))
    for _ in range(2):
        heavy = pruned(heavy.withColumn("part", (F.col("part") / FAN).cast("int")).repartition("cluster", "clustered", "part"))
    kept = pruned(told(light)).unionByName(heavy)
    groups = max(1, -(-clusters // GROUP))
    return kept.withColumn("bucket", F.pmod(F.xxhash64("cluster", "clustered"), F.lit(groups))).groupBy("bucket").applyInPandas(_resolve, _GOLDEN)


def _ordered(df: pd.DataFrame) -> pd.DataFrame:
    """The rows by RECENT. The complement of a whole number orders the other way round, without overflow."""
    down = [~df[c].to_numpy(np.int64) for c in ("tie", "trust", "at")]
    return df.iloc[np.lexsort([down[0], df["client"].to_numpy(np.int64), ~df["known"].to_numpy(bool), down[1], down[2]])].reset_index(drop=True)


def survivors(df: pd.DataFrame) -> pd.DataFrame:
    """The rows that win a slot of their cluster; one of them has the counts of all the cluster's rows."""
    df = _ordered(df)
    ident, slot = ["cluster", "clustered"], ["cluster", "clustered", "trust"]
    lengths = df["name"].str.len().where(df["name"].notna(), -1).fillna(-1).astype("int64").to_numpy()
    filled = df["city"].notna().to_numpy().astype(int) + df["nation"].notna().to_numpy()
    first = lambda rows, keys: rows.drop_duplicates(keys).index
    by = lambda score: df.iloc[np.argsort(-score, kind="stable")]
    wins = [
        first(df[df["email"].notna()], slot), first(df[df["segment"].notna()], ident), first(by(lengths)[lambda x: x["name"].notna()], slot),
        first(by(filled), slot), first(df[df["balance"].notna()], [*ident, "chosen"]),
    ]
    kept = df.loc[np.unique(np.concatenate(wins))].copy()
    counts = df.groupby(ident, sort=False)[["n", "n_stale"]].sum()
    lead = ~kept.duplicated(ident).to_numpy()
    kept[["n", "n_stale"]] = 0
    kept.loc[lead, ["n", "n_stale"]] = counts.loc[pd.MultiIndex.from_frame(kept.loc[lead, ident])].to_numpy()
    return kept


_ARROW = pa.schema([
    ("cluster", pa.int64()), ("clustered", pa.bool_()), ("client", pa.int64()), ("known", pa.bool_()), ("trust", pa.int32()), ("name", pa.string()), ("email", pa.string()), ("city", pa.string()),
    ("nation", pa.int32()), ("segment", pa.string()), ("balance", pa.float64()), ("chosen", pa.bool_()), ("stale", pa.bool_()), ("tie", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("n_stale", pa.int64()), ("part", pa.int32()),
])


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Survivors of a partition. Rows that come with counts and a part are survivors already, of finer parts."""
    from pyspark import TaskContext

    here, held, size = TaskContext.get().partitionId(), [], 0

    def out(df: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_pandas(df, _ARROW, preserve_index=False).to_batches(common.OUT_ROWS)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if "part" not in table.column_names:
            at = table.column("at").cast(pa.timestamp("us")).cast(pa.int64()).fill_null(NEVER)
            table = table.drop_columns(["at"]).append_column("at", at)
        df = table.to_pandas()
        if "part" not in df:
            df = df.assign(n=1, n_stale=df["stale"].astype("int64"), part=here)
        df["nation"] = df["nation"].astype("Int32")
        held.append(df[_ARROW.names])
        size += len(df)
        if size >= HELD:
            kept = survivors(pd.concat(held, ignore_index=True))
            held, size = ([kept], len(kept)) if len(kept) < HELD // 2 else ([], 0)
            if not held:
                yield from out(kept)
    if held:
        yield from out(survivors(pd.concat(held, ignore_index=True)))


def _resolve(df: pd.DataFrame) -> pd.DataFrame:
    """The golden records of a group of clusters from all their survivors."""
    df = _ordered(df)
    ident = ["cluster", "clustered"]
    trusted = df.iloc[np.lexsort([np.arange(len(df)), ~df["trust"].to_numpy(np.int64), df["stale"].to_numpy(bool)])]
    counts = df.groupby(ident, sort=False)[["n", "n_stale"]].sum()

    def pick(ordered: pd.DataFrame, field: str) -> np.ndarray:
        """For each cluster the row that comes first of those with the field; len(df) where there is none."""
        won = ordered[ordered[field].notna()].drop_duplicates(ident)
        return pd.Series(won.index, index=pd.MultiIndex.from_frame(won[ident])).reindex(counts.index, fill_value=len(df)).to_numpy(np.int64)

    def column(values: pd.Series, there: pd.Series, whole: bool = False) -> np.ndarray:
        """The values as Python has them, None where there is none, and a None at the end."""
        kind = "int64" if whole else object
        return np.append(np.where(there.to_numpy(bool), values.where(there, 0 if whole else None).astype(kind).astype(object).to_numpy(), None), None)

    fields = {f: column(df[f], df[f].notna()) for f in ("name", "email", "segment", "city", "balance")}
    fields |= {"nation": column(df["nation"], df["nation"].notna(), True), "client": column(df["client"], df["known"].astype(bool), True)}
    lengths = trusted["name"].str.len().fillna(-1).astype("int64").to_numpy()
    filled = trusted["city"].notna().to_numpy().astype(int) + trusted["nation"].notna().to_numpy()
    won = {
        "name": pick(trusted.iloc[np.argsort(-lengths, kind="stable")], "name"), "email": pick(trusted, "email"), "segment": pick(df, "segment"),
        "balance": pick(df.iloc[np.argsort(~df["chosen"].to_numpy(bool), kind="stable")], "balance"), "address": pick(trusted.iloc[np.argsort(-filled, kind="stable")], "trust"),
    }
    cities, nations = fields["city"][won["address"]], fields["nation"][won["address"]]
    cents = [None if x is None else int(np.floor(100 * x + 0.5)) for x in fields["balance"][won["balance"]]]
    supplied = [c if city is not None or nation is not None else None for c, city, nation in zip(fields["client"][won["address"]], cities, nations, strict=True)]
    whole = lambda values, kind="Int64": pd.array(list(values), dtype=kind)
    return pd.DataFrame({
        "cluster_id": whole(c if there else None for c, there in counts.index), "n_records": counts["n"].to_numpy(), "n_stale": counts["n_stale"].to_numpy(),
        **{f: fields[f][won[f]] for f in ("name", "email", "segment")}, "city": cities, "nation_id": whole(nations, "Int32"), "balance_cents": whole(cents),
        **{f"{f}_from": whole(fields["client"][won[f]]) for f in ("name", "email", "segment", "balance")}, "address_from": whole(supplied),
    })
