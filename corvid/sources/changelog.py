"""A corpus kept as changes: a run writes what it changes, reading merges, and folding keeps reading cheap.

Folders of a log (all Parquet, each put in place by one rename, so that a name is there whole or not at all):

- change-<a>-<b>: what commits a to b changed, the newest row of each URL. A row with gone set is a tombstone.
- whole-<n>: the corpus after commit n.

Reading takes the newest whole and the changes after it. Only the URLs of these changes are compared; the rows of the whole stream
through an anti join with them, which is a broadcast where they are few. A log has one writer at a time; readers need no lock.

Cost: a commit of n rows writes n rows. FOLD changes of the same span become one of FOLD times the span, so that a row is rewritten once a span; when
the changes outgrow SHARE of the whole, a new whole is written, whose cost is then in proportion to the rows that came.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import ARTICLE_COLS
from . import files

#: Folders of a span that are folded into one; size of the changes, as a share of the whole and in bytes, above which a whole is written.
FOLD, SHARE, LEAST = 8, 0.5, 64 << 20
#: gone: a tombstone; filled: the text isn't blank, so that a run need not read texts to know what it may skip.
LOGGED = (*ARTICLE_COLS, "seq", "pos", "gone", "filled")


class ChangeLog:
    def __init__(self, spark: SparkSession, path: str, fold: int = FOLD, share: float = SHARE, least: int = LEAST):
        self.spark, self.path, self.fold, self.share, self.least = spark, path, fold, share, least

    def _folders(self) -> tuple[int, list[tuple[int, int]]]:
        """The newest whole (0: none) and the widest changes that go on from it."""
        names = files.children(self.spark, self.path)
        whole = max((int(m[1]) for n in names if (m := re.fullmatch(r"whole-(\d+)", n))), default=0)
        spans = [(int(m[1]), int(m[2])) for n in names if (m := re.fullmatch(r"change-(\d+)-(\d+)", n))]
        at, chosen = whole, []
        while nxt := [b for a, b in spans if a == at + 1]:
            chosen.append((at + 1, max(nxt)))
            at = max(nxt)
        if any(b > at for _, b in spans):
            raise ValueError(f"{self.path}: the changes after commit {at} are missing")
        return whole, chosen

    def _whole(self, n: int) -> str:
        return f"{self.path}/whole-{n:09d}"

    def _change(self, a: int, b: int) -> str:
        return f"{self.path}/change-{a:09d}-{b:09d}"

    def version(self) -> int:
        """The number of the last commit; 0 where there is none."""
        whole, spans = self._folders()
        return spans[-1][1] if spans else whole

    def _rows(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(_schema()).parquet(*paths)

    def _newest(self, spans: list[tuple[int, int]], columns: list[str]) -> DataFrame:
        """The newest change of each URL."""
        rest = [c for c in columns if c not in ("url", "seq", "pos", "gone")]
        rows = self._rows(*[self._change(*s) for s in spans])
        if len(spans) == 1:
            return rows.select("url", "seq", "pos", "gone", *rest)
        return rows.groupBy("url").agg(F.max(F.struct("seq", "pos", "gone", *rest)).alias("r")).select("url", "r.*")

    def read(self, *columns: str) -> DataFrame:
        """The rows of the corpus, their order being (seq, pos); columns: those wanted (default: the article's)."""
        wanted = list(dict.fromkeys(["url", "seq", "pos", *(columns or ARTICLE_COLS)]))
        whole, spans = self._folders()
        parts = []
        if whole:
            base = self._rows(self._whole(whole)).select(*wanted)
            if spans:
                base = base.join(self._rows(*[self._change(*s) for s in spans]).select("url"), "url", "left_anti")
            parts.append(base)
        if spans:
            parts.append(self._newest(spans, wanted).where(~F.col("gone")).select(*wanted))
        if not parts:
            return self.spark.createDataFrame([], _schema()).select(*wanted)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def held(self) -> DataFrame:
        """url, filled of all rows: what a run has to know of them."""
        return self.read("filled").select("url", "filled")

    def done(self, batch: str) -> bool:
        """Whether the commit of a batch is in."""
        return any(files.exists(self.spark, f"{self.path}/{n}/_batch-{batch}") for n in files.children(self.spark, self.path) if not n.startswith("_"))

    def commit(self, changes: DataFrame, batch: str | None = None, metrics: dict | None = None) -> dict:
        """Appends changes (article columns, pos, gone) and gives their metrics, counted as they are written. A batch that has its commit is passed
        over. metrics: name -> aggregate over the changes; rows and gone come with them."""
        if batch is not None and self.done(batch):
            return {"rows": 0, "gone": 0}
        self._keep_up()
        n = self.version() + 1
        counted = Observation()
        filled = F.trim(F.coalesce("text", F.lit(""))) != ""
        rows = changes.select(*ARTICLE_COLS, F.lit(n).cast("bigint").alias("seq"), F.col("pos").cast("bigint").alias("pos"), F.col("gone"), filled.alias("filled"))
        rows = rows.observe(counted, F.count_if(~F.col("gone")).alias("rows"), F.count_if("gone").alias("gone"), *[v.alias(k) for k, v in (metrics or {}).items()])
        staged = self._written(rows, [batch] if batch else [])
        found = counted.get
        if found["rows"] + found["gone"]:
            files.renamed(self.spark, staged, self._change(n, n))
        else:
            files.deleted(self.spark, staged)
        return found

    def _written(self, rows: DataFrame, batches: list[str]) -> str:
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        rows.select(*LOGGED).write.parquet(staged)
        for b in batches:
            files.touched(self.spark, f"{staged}/_batch-{b}")
        return staged

    def _batches(self, folders: list[str]) -> list[str]:
        """The last batch of each stream that the folders hold (a batch is <stream>-<number>)."""
        last: dict[str, int] = {}
        for f in folders:
            for n in files.children(self.spark, f):
                if m := re.fullmatch(r"_batch-(.*)-(\d+)", n):
                    last[m[1]] = max(last.get(m[1], -1), int(m[2]))
        return [f"{s}-{n}" for s, n in last.items()]

    def _keep_up(self) -> None:
        """Folds and compacts what is due."""
        whole, spans = self._folders()
        size = lambda paths: sum(files.size(self.spark, p) for p in paths)
        grown = size([self._change(*s) for s in spans])
        if grown > max(self.least, self.share * (size([self._whole(whole)]) if whole else 0)):
            self.compact()
            return
        while len(spans) >= self.fold and len({b - a for a, b in spans[-self.fold :]}) == 1:
            tail = spans[-self.fold :]
            a, b = tail[0][0], tail[-1][1]
            staged = self._written(self._newest(tail, list(LOGGED)), self._batches([self._change(*s) for s in tail]))
            files.renamed(self.spark, staged, self._change(a, b))
            spans = self._folders()[1]

    def compact(self) -> None:
        """Writes a new whole; what it replaces stays until vacuum()."""
        whole, spans = self._folders()
        if spans:
            batches = self._batches([*([self._whole(whole)] if whole else []), *[self._change(*s) for s in spans]])
            rows = self.read(*[c for c in LOGGED if c != "gone"]).withColumn("gone", F.lit(False))
            files.renamed(self.spark, self._written(rows, batches), self._whole(spans[-1][1]))

    def vacuum(self) -> list[str]:
        """Deletes the folders that reading no longer uses, and what writers that died left behind; gives their names. Run it when no reader
        that began before the last commit is left, and no writer."""
        whole, spans = self._folders()
        used = {f"whole-{whole:09d}", *(f"change-{a:09d}-{b:09d}" for a, b in spans)}
        gone = [n for n in files.children(self.spark, self.path) if re.fullmatch(r"(whole|change)-[\d-]+|_staged-.*", n) and n not in used]
        for n in gone:
            files.deleted(self.spark, f"{self.path}/{n}")
        return gone


def _schema() -> str:
    return ", ".join([*(f"{c} string" for c in ARTICLE_COLS), "seq bigint, pos bigint, gone boolean, filled boolean"])
