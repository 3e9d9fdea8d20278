"""Keyed real-time serving store (K5, ST5, ST6, ST7, ST8, ST9, A1/A2/A14, T1/T3, J5).

State is Parquet in hash buckets of the content id, merged once per micro-batch:

``<path>/stats/v=S/bucket=B``   one row per content: counts, exact-decimal sums, latest
                                metadata, distinct-user state (see below)
``<path>/recent/v=S/bucket=B``  newest ``history`` events per content (bounded)
``<path>/pairs/v=S/bucket=B``   first sightings of (content_id, user_id), exact mode
``<path>/events/v=S``           the per-event records of one commit (event cache)
``<path>/_commits/S``           the commit: which version holds each bucket, and which
                                batches of which source are in

A commit has the next sequence number S, whatever the batch is called: stream batches,
backfills and batches of a restarted stream are applied in the order they arrive. It reads and
rewrites only the buckets whose contents the batch touches, and points to earlier versions for
all others, so its cost follows the batch and not the history. A batch is known by (source,
batch id): replaying the newest commit replaces it, replaying an older one changes nothing.
Every ``COMPACT_AFTER`` pair files of a bucket are folded into one, and versions that the
last ``keep`` commits do not use are removed, both as part of writing.

Distinct users: ``exact`` keeps the (content, user) pairs seen so far; a batch counts only
pairs absent from the buckets it touches (semi join; broadcast only behind a size check).
``sketch`` keeps a mergeable HLL sketch per content (``hll_sketch_agg`` / ``hll_union``):
bounded state for very large audiences.
"""

from __future__ import annotations

import copy
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.functions import engagement as fx
from eventide.functions.time import trailing
from eventide.operators import projections as proj
from eventide.operators.joins import DEFAULT_BROADCAST_BYTES, maybe_broadcast
from eventide.sinks import fs

#: Hash buckets of the state; give a large catalogue more (a bucket is rewritten as a whole).
BUCKETS = 16
COMPACT_AFTER = 16
#: Rows of (content, user) ids, 36 characters each, that fit the broadcast bound.
PAIR_ROWS = DEFAULT_BROADCAST_BYTES // 128
T_SUM = "decimal(38,2)"
T_SCORE_SUM = "decimal(38,5)"
_EMPTY = {"seq": 0, "prev": 0, "source": None, "batch": None, "done": {}, "stats": {}, "recent": {},
          "pairs": {}, "events": []}


class ServingStore:
    def __init__(self, spark: SparkSession, path: str, history: int = 1000,
                 distinct: str = "exact", buckets: int = BUCKETS, keep: int = 8,
                 event_cache: bool = True):
        if distinct not in ("exact", "sketch"):
            raise ValueError("distinct must be 'exact' or 'sketch'")
        self.spark = spark
        self.path = path.rstrip("/")
        self.history = history
        self.distinct = distinct
        self.buckets = buckets
        self.keep = max(2, keep)  # the newest commit's predecessor must stay for its replay
        self.event_cache = event_cache

    # ---- commits --------------------------------------------------------------------
    def committed(self) -> list[int]:
        """Sequence numbers of the commits that are kept (at most ``keep`` and a few more)."""
        return sorted(int(n) for n in fs.list_names(self.spark, f"{self.path}/_commits")
                      if n.isdigit())

    def latest(self) -> int | None:
        seqs = self.committed()
        return seqs[-1] if seqs else None

    def _manifest(self, seq: int | None) -> dict:
        if not seq:
            return copy.deepcopy(_EMPTY)
        return json.loads(fs.read_text(self.spark, f"{self.path}/_commits/{seq}"))

    def _read(self, name: str, manifest: dict, buckets: list[int] | None = None
              ) -> DataFrame | None:
        """The current files of ``name``, of all buckets or of the given ones."""
        chosen = manifest[name]
        paths = []
        for b, seqs in sorted(chosen.items()):
            if buckets is None or int(b) in buckets:
                for s in seqs if isinstance(seqs, list) else [seqs]:
                    paths.append(f"{self.path}/{name}/v={s}/bucket={b}")
        return self.spark.read.parquet(*paths) if paths else None

    def _bucket(self):
        return F.pmod(F.xxhash64("content_id"), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, name: str, seq: int) -> None:
        (df.withColumn("bucket", self._bucket()).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/v={seq}"))

    # ---- write one batch ------------------------------------------------------------
    def bucket_of(self):
        """The bucket number of a row's content."""
        return self._bucket()

    def write_batch(self, enriched: DataFrame, batch_id: int, batch_rows: int | None = None,
                    source: str = "stream", touched: list[int] | None = None) -> None:
        """Merge one batch and commit it.

        ``source`` names where batch ids come from (a streaming query's id, or a backfill); ids
        of one source must not be used twice for different batches. ``batch_rows`` (when the
        caller counted the batch) bounds the batch's distinct pairs, so the broadcast decision
        needs no extra count; ``touched`` are the batch's bucket numbers, if known.
        """
        from eventide.streaming.pipeline import _run_concurrently

        head = self._manifest(self.latest())
        base = head
        if batch_id in head["done"].get(source, []):
            if (head["source"], head["batch"]) != (source, batch_id):
                return  # in, and later commits build on it
            base = self._manifest(head["prev"])  # replay of the newest: replace it
        seq = head["seq"] + 1
        if touched is None:
            touched = sorted(r["b"] for r in enriched.select(self._bucket().alias("b")).distinct()
                             .collect())  # at most ``buckets`` numbers
        new = copy.deepcopy(base)
        new |= {"seq": seq, "prev": base["seq"], "source": source, "batch": int(batch_id)}
        # a stream's ids only grow: its last few are enough; a backfill's are all kept
        ids = [b for b in new["done"].get(source, []) if b != batch_id] + [int(batch_id)]
        new["done"][source] = ids if source.startswith("backfill") else ids[-self.keep:]
        if touched:
            small = None if batch_rows is None else batch_rows <= PAIR_ROWS

            def stats() -> None:
                self._write(self._merge_stats(enriched, seq, base, new, touched, small),
                            "stats", seq)

            def recent() -> None:
                self._write(self._merge_recent(enriched, base, touched), "recent", seq)

            def events() -> None:
                (proj.to_event_record(enriched).write.mode("overwrite")
                 .parquet(f"{self.path}/events/v={seq}"))

            _run_concurrently([stats, recent] + [events] * self.event_cache, self.spark)
            for b in touched:
                new["stats"][str(b)] = new["recent"][str(b)] = seq
            if self.event_cache:
                new["events"] = base["events"] + [seq]
        fs.write_text(self.spark, f"{self.path}/_commits/{seq}", json.dumps(new))
        self._retain(new)

    def _retain(self, newest: dict) -> None:
        """ST8: drop commits beyond the last ``keep``, and versions that no kept one uses."""
        seqs = self.committed()
        old, kept = seqs[:-self.keep], seqs[-self.keep:]
        if not old:
            return
        manifests = [self._manifest(s) for s in kept] + [newest]
        for name in ("stats", "recent", "pairs", "events"):
            used: set[int] = set()
            for m in manifests:
                groups = m[name] if isinstance(m[name], list) else m[name].values()
                for g in groups:
                    used.update(g if isinstance(g, list) else [g])
            for n in fs.list_names(self.spark, f"{self.path}/{name}"):
                if n.startswith("v=") and int(n[2:]) not in used and int(n[2:]) < newest["seq"]:
                    fs.delete(self.spark, f"{self.path}/{name}/{n}")
        for s in old:
            fs.delete(self.spark, f"{self.path}/_commits/{s}")

    def expire_events(self, as_of, hours: int = 24) -> list[int]:
        """ST8: drop the event records of commits that ended ``hours`` before ``as_of``; returns
        the commits dropped. (Contents' histories expire when they are read, ``recent_events``.)"""
        from eventide.functions.time import minus

        head = self._manifest(self.latest())
        if not head["events"]:
            return []
        paths = [f"{self.path}/events/v={s}" for s in head["events"]]
        ended = (self.spark.read.parquet(*paths)
                 .groupBy(F.regexp_extract(F.input_file_name(), "/v=([0-9]+)/", 1).cast("long")
                          .alias("s")).agg(F.max("event_ts").alias("last"))
                 .where(F.col("last") <= minus(as_of, hours, "HOUR")))
        gone = sorted(r["s"] for r in ended.collect())  # one number per commit
        if gone:
            new = copy.deepcopy(head)
            new |= {"seq": head["seq"] + 1, "events": [s for s in head["events"] if s not in gone]}
            fs.write_text(self.spark, f"{self.path}/_commits/{new['seq']}", json.dumps(new))
            self._retain(new)
        return gone

    def _batch_stats(self, enriched: DataFrame) -> DataFrame:
        es = fx.nullif_zero("engagement_seconds")
        pct = fx.nullif_zero("engagement_pct")
        aggs = [F.max_by(F.struct("slug", "title", "content_type"), "event_ts").alias("_m"),
                F.count(F.lit(1)).alias("total_events"),
                F.sum(fx.content_score()).cast(T_SCORE_SUM).alias("score"),
                F.sum(es).cast(T_SUM).alias("es_sum"),
                F.sum(pct).cast(T_SUM).alias("pct_sum"),
                F.count(pct).alias("pct_count"),
                F.max("event_ts").alias("last_updated")]
        if self.distinct == "sketch":
            aggs.append(F.hll_sketch_agg("user_id").alias("users_sketch"))
        measures = ["total_events", "score", "es_sum", "pct_sum", "pct_count", "last_updated"]
        if self.distinct == "sketch":
            measures.append("users_sketch")
        return (enriched.groupBy("content_id").agg(*aggs)
                .select("content_id", "_m.slug", "_m.title", "_m.content_type", *measures))

    def _new_users(self, enriched: DataFrame, seq: int, base: dict, new: dict,
                   touched: list[int], small: bool | None) -> DataFrame:
        """Exact mode: write the batch's first-seen (content, user) pairs of the touched buckets
        and return them as ``(content_id, unique_users=1)`` rows. A bucket with COMPACT_AFTER
        files gets its whole history rewritten into one."""
        pairs = enriched.select("content_id", "user_id").distinct()
        hist = self._read("pairs", base, touched)
        fresh = pairs
        if hist is not None:
            hist = hist.select("content_id", "user_id")
            seen = hist.join(maybe_broadcast(pairs, known_small=small), ["content_id", "user_id"],
                             "left_semi")
            fresh = pairs.join(seen, ["content_id", "user_id"], "left_anti")
        full = [b for b in touched if len(base["pairs"].get(str(b), [])) >= COMPACT_AFTER]
        out = fresh.withColumn("fresh", F.lit(True))
        if full:
            past = self._read("pairs", base, full).select("content_id", "user_id")
            out = out.unionByName(past.withColumn("fresh", F.lit(False)))
        self._write(out, "pairs", seq)
        have = {int(n[7:]) for n in fs.list_names(self.spark, f"{self.path}/pairs/v={seq}")
                if n.startswith("bucket=")}
        for b in have:
            past = [] if b in full else base["pairs"].get(str(b), [])
            new["pairs"][str(b)] = past + [seq]
        written = self.spark.read.schema("content_id string, user_id string, fresh boolean"
                                         ).parquet(f"{self.path}/pairs/v={seq}")
        # one row per first-seen pair; the merge aggregation sums them per content
        return written.where("fresh").select("content_id",
                                             F.lit(1).cast("long").alias("unique_users"))

    def _merge_stats(self, enriched: DataFrame, seq: int, base: dict, new: dict,
                     touched: list[int], small: bool | None) -> DataFrame:
        """Merge by re-aggregation: previous rows, the batch's partial rows and the batch's
        new-user counts are stacked and folded per content in one aggregation (no joins)."""
        parts = [self._batch_stats(enriched)]
        if self.distinct == "exact":
            parts.append(self._new_users(enriched, seq, base, new, touched, small))
        prev = self._read("stats", base, touched)
        if prev is not None:
            parts.insert(0, prev)
        stacked = parts[0]
        for extra in parts[1:]:
            stacked = stacked.unionByName(extra, allowMissingColumns=True)
        aggs = [F.max_by(F.struct("slug", "title", "content_type"), "last_updated").alias("_m"),
                F.coalesce(F.sum("total_events"), F.lit(0)).cast("long").alias("total_events"),
                F.sum("score").cast(T_SCORE_SUM).alias("score"),
                F.sum("es_sum").cast(T_SUM).alias("es_sum"),
                F.sum("pct_sum").cast(T_SUM).alias("pct_sum"),
                F.coalesce(F.sum("pct_count"), F.lit(0)).cast("long").alias("pct_count"),
                F.max("last_updated").alias("last_updated")]
        if self.distinct == "exact":
            aggs.append(F.coalesce(F.sum("unique_users"), F.lit(0)).cast("long")
                        .alias("unique_users"))
        else:
            aggs.append(F.hll_union_agg("users_sketch").alias("users_sketch"))
        users = "unique_users" if self.distinct == "exact" else "users_sketch"
        return (stacked.groupBy("content_id").agg(*aggs)
                .select("content_id", "_m.slug", "_m.title", "_m.content_type", "total_events",
                        "score", "es_sum", "pct_sum", "pct_count", "last_updated", users))

    def _merge_recent(self, enriched: DataFrame, base: dict, touched: list[int]) -> DataFrame:
        w = Window.partitionBy("content_id").orderBy(F.desc("event_ts"), F.desc("event_id"))
        # the batch side first keeps its own newest ``history`` rows per content (Spark applies
        # the limit partially before the shuffle), so a content with a large share of a big
        # batch never sends all its rows to one task
        cur = (self._once(proj.to_recent_event(enriched))
               .withColumn("_rn", F.row_number().over(w))
               .where(F.col("_rn") <= self.history).drop("_rn"))
        prev = self._read("recent", base, touched)
        allr = cur if prev is None else self._once(prev.unionByName(cur))
        return (allr.withColumn("_rn", F.row_number().over(w))
                .where(F.col("_rn") <= self.history).drop("_rn"))

    @staticmethod
    def _once(records: DataFrame) -> DataFrame:
        """One row per (content, event): the latest of an event that was sent again, whatever
        its times (a combining aggregation)."""
        others = [c for c in records.columns if c not in ("content_id", "event_id")]
        newest = F.max_by(F.struct(*others), F.struct("event_ts", F.hash(*others))).alias("_r")
        return (records.groupBy("content_id", "event_id").agg(newest)
                .select("content_id", "event_id", *[F.col(f"_r.{c}").alias(c) for c in others])
                .select(*records.columns))

    # ---- read side ------------------------------------------------------------------
    def content_stats(self, version: int | None = None) -> DataFrame:
        """A1 + A14 + P10 serving rows of the newest (or a given) committed version."""
        v = self.latest() if version is None else version
        s = self._read("stats", self._manifest(v)) if v else None
        if s is None:
            raise FileNotFoundError(f"no committed rows under {self.path}")
        users = (F.col("unique_users") if self.distinct == "exact"
                 else F.hll_sketch_estimate("users_sketch"))
        return s.select(
            "content_id", "slug", "title", "content_type", "total_events",
            users.cast("long").alias("unique_users"),
            F.coalesce(F.col("es_sum").cast("double"), F.lit(0.0)).alias("total_engagement_seconds"),
            F.try_divide(F.col("pct_sum").cast("double"), F.col("pct_count")).alias("avg_engagement_pct"),
            F.col("score").cast("double").alias("score"), "last_updated")

    def top_content(self, k: int = 10, version: int | None = None) -> DataFrame:
        """T1/ST9/J5: top-k by cumulative score with metadata and stats."""
        return (self.content_stats(version).where(F.col("score") > 0)
                .orderBy(F.desc("score"), F.desc("content_id")).limit(k))

    def recent_events(self, n: int = 50, version: int | None = None, as_of=None,
                      ttl_minutes: int | None = None) -> DataFrame:
        """Newest ``n`` events per content.

        With ``as_of`` and ``ttl_minutes`` (ST6: the history expires an hour after the
        content's last event) only contents active within the TTL keep a history.
        """
        v = self.latest() if version is None else version
        r = self._read("recent", self._manifest(v))
        if r is None:
            raise FileNotFoundError(f"no committed rows under {self.path}")
        w = Window.partitionBy("content_id").orderBy(F.desc("event_ts"), F.desc("event_id"))
        r = r.withColumn("position", F.row_number().over(w))
        if as_of is not None and ttl_minutes is not None:
            from eventide.functions.time import ts_lit
            cutoff = ts_lit(as_of) - F.expr(f"INTERVAL {int(ttl_minutes)} MINUTE")
            r = (r.withColumn("_last", F.max("event_ts").over(Window.partitionBy("content_id")))
                 .where(F.col("_last") > cutoff).drop("_last"))
        return r.where(F.col("position") <= n).drop("event_ts")

    def cached_events(self, as_of, hours: int = 24) -> DataFrame:
        """P8/ST7: per-event records of the ``hours`` before ``as_of``, one per event id."""
        head = self._manifest(self.latest())
        if not head["events"]:
            raise FileNotFoundError(f"no event records under {self.path}")
        r = self.spark.read.parquet(*[f"{self.path}/events/v={s}" for s in head["events"]])
        live = r.where(trailing("event_ts", as_of, hours, "HOUR"))
        others = [c for c in live.columns if c != "event_id"]
        newest = F.max_by(F.struct(*others), F.struct("event_ts", F.hash(*others))).alias("_r")
        return (live.groupBy("event_id").agg(newest)
                .select("event_id", *[F.col(f"_r.{c}").alias(c) for c in others])
                .drop("event_ts"))
