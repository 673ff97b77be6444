"""Two-level label taxonomy: resolving proposals, families, backfill, priorities."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracequarry.functions import text as tx
from tracequarry.functions import vectors
from tracequarry.lineage import materialize

DUPLICATE, MOUNT = 0.85, 0.50
BACKFILL_TOP = 200
#: Rows of a group of items or known rows; cosines of a product that may be equal.
GROUP, NEAR = 1024, 1e-9


def nearest(items: DataFrame, known: DataFrame, item: str, name: str, order: str) -> DataFrame:
    """item, the most similar known row's name and its cosine; the first in ``order`` of equals.

    Vectors that are null, zero or of another length have cosine 0.  Items and known rows are dealt to groups of about ``GROUP``
    rows; two groups meet in one matrix product, and an item keeps the best of a group."""
    kinds = dict(items.dtypes)[item], dict(known.dtypes)[name]
    ranked = known.select(F.col(name).alias("name"), F.col(order).cast("double").alias("o"), F.col("vector").cast("array<double>").alias("v"))
    asked = items.select(F.col(item).alias("item"), F.col("vector").cast("array<double>").alias("v"))
    ranked, asked = materialize(ranked, "known"), materialize(asked, "asked")
    sides = [max(1, -(-t.count() // GROUP)) for t in (asked, ranked)]
    every = lambda n, as_: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(as_)
    # of one type on both sides: cogroup compares keys as they are, and a long and an int with the same value go to different partitions
    dealt = lambda n, as_, *by: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int").alias(as_)
    left = asked.select("item", "v", dealt(sides[0], "i", "item", "v"), every(sides[1], "g"))
    right = ranked.select("name", "o", "v", dealt(sides[1], "g", "name", "o"), every(sides[0], "i"))

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values(["o", "name"], kind="stable").reset_index(drop=True)
        if not len(left) or not len(right):
            return pd.DataFrame({"item": left["item"][:0], "name": right["name"][:0], "o": right["o"][:0], "cos": right["o"][:0]})
        a, b = _units(left["v"]), _units(right["v"])
        near = np.zeros((len(left), len(right)))
        for dim in set(a) & set(b):
            (rows, x), (columns, y) = a[dim], b[dim]
            near[np.ix_(rows, columns)] = x @ y.T
        at, cos = np.zeros(len(left), int), np.zeros(len(left))
        like = near >= near.max(axis=1, keepdims=True) - NEAR
        for k, v in enumerate(left["v"]):  # a product's rounding depends on the place, so what lies close is computed alike
            some = np.flatnonzero(like[k])
            exact = [_cosine(v, right["v"][j]) for j in some]
            j = int(np.argmax(exact))
            at[k], cos[k] = some[j], exact[j]
        return pd.DataFrame({"item": left["item"], "name": right["name"].to_numpy()[at], "o": right["o"].to_numpy()[at], "cos": cos})

    found = left.groupBy("i", "g").cogroup(right.groupBy("i", "g")).applyInPandas(best, f"item {kinds[0]}, name {kinds[1]}, o double, cos double")
    top = F.max(F.struct("cos", (-F.col("o")).alias("o"), "name"))
    return found.groupBy("item").agg(top.alias("b")).select(F.col("item").alias(item), F.col("b.name").alias(name), F.col("b.cos").alias("cosine"))


def _units(vectors_: pd.Series) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors of each length; zero vectors stay."""
    size = np.array([-1 if v is None else len(v) for v in vectors_])
    out = {}
    for dim in set(size.tolist()) - {-1, 0}:
        rows = np.flatnonzero(size == dim)
        x = np.array([vectors_.iloc[k] for k in rows], float)
        long = np.linalg.norm(x, axis=1, keepdims=True)
        out[dim] = rows, np.divide(x, long, out=np.zeros_like(x), where=long > 0)
    return out


def _cosine(a, b) -> float:
    if a is None or b is None or len(a) != len(b):
        return 0.0
    a, b = np.asarray(a, float), np.asarray(b, float)
    size = float(np.linalg.norm(a) * np.linalg.norm(b))
    return float(np.einsum("i,i->", a, b)) / size if size else 0.0


def cosine_range(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row: least, largest and mean cosine of known (child, parent) vectors; the mount threshold lies just below the least."""
    cos = vectors.cosine(F.col(a), F.col(b))
    return pairs.agg(F.min(cos).alias("least"), F.max(cos).alias("largest"), F.avg(cos).alias("mean"))


def resolution(any_cos: Column, any_label: Column, root_cos: Column, root_label: Column) -> Column:
    """struct(kind, target): a duplicate of any label, a leaf below a root, or a root."""
    return (
        F.when(any_cos > DUPLICATE, F.struct(F.lit("duplicate").alias("kind"), any_label.alias("target")))
        .when(root_cos >= MOUNT, F.struct(F.lit("new_leaf").alias("kind"), root_label.alias("target")))
        .otherwise(F.struct(F.lit("new_root").alias("kind"), F.lit(None).cast("string").alias("target")))
    )


def resolve(proposals: DataFrame, labels: DataFrame) -> DataFrame:
    """proposals (proposal, vector) against labels (label, parent, vector, ord): kind and target."""
    every = nearest(proposals, labels, "proposal", "label", "ord").withColumnsRenamed({"label": "any_label", "cosine": "any_cos"})
    roots = nearest(proposals, labels.where("parent is null"), "proposal", "label", "ord").withColumnsRenamed({"label": "root_label", "cosine": "root_cos"})
    both = proposals.select("proposal").join(every, "proposal", "left").join(roots, "proposal", "left")
    found = resolution(F.col("any_cos"), F.col("any_label"), F.col("root_cos"), F.col("root_label"))
    return both.withColumn("r", found).select("proposal", "r.kind", "r.target", "any_cos", "root_cos")


def leaves(labels: DataFrame) -> DataFrame:
    """Labels that are no other label's parent."""
    return labels.join(labels.where("parent is not null").select(F.col("parent").alias("label")).distinct(), "label", "left_anti")


def families(labels: DataFrame) -> DataFrame:
    """label and ``family``: its parent and the other children of the parent."""
    a = labels.where("parent is not null").select("label", "parent")
    kids = a.groupBy("parent").agg(F.collect_set("label").alias("kids"))
    both = F.sort_array(F.array_union(F.array("parent"), F.array_except("kids", F.array("label"))))
    return labels.select("label").join(a.join(kids, "parent").select("label", both.alias("family")), "label", "left").withColumn(
        "family", F.coalesce("family", F.expr("cast(array() as array<string>)"))
    )


def prompt_tree(labels: DataFrame) -> DataFrame:
    """One line per label in prompt order: roots with their children below them."""
    line = F.concat(F.when(F.col("parent").isNull(), "- ").otherwise("  - "), F.col("label"), F.lit(": "), F.coalesce("description", F.lit("")))
    root = F.coalesce("parent", "label")
    return labels.select(root.alias("root"), F.col("parent").isNotNull().alias("is_child"), "label", line.alias("line"))


def merged_labels(old: Column, new: Column) -> Column:
    """Order-preserving union; null counts as none."""
    none = F.expr("cast(array() as array<string>)")
    return F.array_distinct(F.concat(F.coalesce(old, none), F.coalesce(new, none)))


def update_labels(signatures: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Signatures with ``found`` (keys, labels) merged in; keys that don't exist change nothing."""
    new = found.groupBy(*keys).agg(F.flatten(F.collect_list("labels")).alias("__new"))
    out = signatures.join(new, keys, "left")
    merged = F.when(F.col("__new").isNull(), F.col("capability_labels")).otherwise(merged_labels(F.col("capability_labels"), F.col("__new")))
    return out.withColumn("capability_labels", merged).drop("__new")


def backfill_candidates(hits: DataFrame, label: Column, top: int = BACKFILL_TOP) -> DataFrame:
    """The best recalled rows that don't have the label yet."""
    labels = F.coalesce("capability_labels", F.expr("cast(array() as array<string>)"))
    return hits.where((F.col("rank") <= top) & ~F.array_contains(labels, label))


def priorities(proposals: DataFrame) -> DataFrame:
    """Jobs: a label's priority is the number of sub-problems that ask for it; first job of a label counts."""
    return proposals.groupBy("label").agg(F.countDistinct("sub_problem_id").alias("priority"), F.min("seq").alias("job_id"))


def ingest_proposals(proposals: list[dict], labels: list[dict], created_at: str) -> tuple[list[dict], list[dict]]:
    """Resolve and add one proposal after another, as later ones see earlier ones. Few rows, on the driver.

    Returns the labels and each proposal's resolution."""
    from math import sqrt

    def cos(a: list[float], b: list[float]) -> float:
        la, lb = sqrt(sum(x * x for x in a)), sqrt(sum(x * x for x in b))
        return sum(x * y for x, y in zip(a, b)) / (la * lb) if la and lb else 0.0

    labels, out = [dict(x) for x in labels], []
    for p in proposals:
        v = p["vector"]
        best = max(labels, key=lambda x: cos(v, x["vector"]), default=None)
        if best is not None and cos(v, best["vector"]) > DUPLICATE:
            out.append({"label": p["label"], "kind": "duplicate", "target": best["label"]})
            continue
        roots = [x for x in labels if x["parent"] is None]
        root = max(roots, key=lambda x: cos(v, x["vector"]), default=None)
        mounted = root is not None and cos(v, root["vector"]) >= MOUNT
        parent = root["label"] if mounted else None
        labels.append({**p, "parent": parent, "new_root": not mounted, "taxonomy_extension": True, "created_at": created_at})
        out.append({"label": p["label"], "kind": "new_leaf" if mounted else "new_root", "target": parent})
    return labels, out


JOB = ("job_id", "label", "priority", "status", "attempts", "error")


def claims(jobs: DataFrame, n: int) -> DataFrame:
    """The next ``n`` pending jobs in the order in which a queue would claim them."""
    return jobs.where("status = 'pending'").orderBy(F.desc("priority"), "job_id").limit(n)


def status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count("*").alias("n"))


class TaxonomyStore:
    """Labels and version of the taxonomy in keyed tables; one writer."""

    def __init__(self, labels, meta):
        self.table, self.meta = labels, meta

    def seed(self, labels: DataFrame, version: str, updated_at: str | None = None) -> bool:
        """Write a first taxonomy if there is none; whether it was written."""
        if self.table.count():
            return False
        self.table.append(labels)
        self._stamp(version, updated_at)
        return True

    def _stamp(self, version: str, updated_at: str | None) -> None:
        self.meta.append(self.meta.spark.createDataFrame([("taxonomy", version, updated_at)], self.meta.schema))

    def labels(self) -> DataFrame:
        return self.table.read()

    def state(self) -> tuple[str, str | None]:
        """Version and time of the last change."""
        row = self.meta.get(name="taxonomy").select("version", "updated_at").first()
        return (row.version, row.updated_at) if row else ("0.0.0", None)

    def add(self, labels: DataFrame, now: str | None = None) -> str:
        """Add or replace labels; the patch number goes up, and without ``now`` the time stays."""
        version, before = self.state()
        self.table.append(labels)
        one = self.meta.spark.createDataFrame([(version,)], "v string")
        version = one.select(tx.bump_patch(F.col("v"))).first()[0]
        self._stamp(version, now or before)
        return version


class JobQueue:
    """Priority queue of backfill jobs with one writer. With a keyed table every change is written, and a new queue finds
    what an earlier one left behind."""

    def __init__(self, table=None):
        self.table = table
        rows = table.read().drop("ingest_seq").orderBy("job_id").collect() if table is not None else []  # a row for each label
        self.jobs: list[dict] = [r.asDict() for r in rows]

    def _save(self, *jobs: dict) -> None:
        if self.table is not None and jobs:
            self.table.append(self.table.spark.createDataFrame([tuple(j[c] for c in JOB) for j in jobs], self.table.schema))

    def enqueue(self, label: str, priority: int) -> int:
        self.jobs.append({"job_id": len(self.jobs) + 1, "label": label, "priority": priority, "status": "pending", "attempts": 0, "error": None})
        self._save(self.jobs[-1])
        return len(self.jobs)

    def claim(self) -> dict | None:
        """The pending job with the highest priority, then the oldest."""
        job = min((j for j in self.jobs if j["status"] == "pending"), key=lambda j: (-j["priority"], j["job_id"]), default=None)
        if job:
            job["status"], job["attempts"] = "running", job["attempts"] + 1
            self._save(job)
        return job

    def complete(self, job_id: int) -> None:
        self.jobs[job_id - 1]["status"] = "done"
        self._save(self.jobs[job_id - 1])

    def fail(self, job_id: int, error: str) -> None:
        self.jobs[job_id - 1].update(status="failed", error=error)
        self._save(self.jobs[job_id - 1])

    def reset_stale(self) -> int:
        stale = [j for j in self.jobs if j["status"] == "running"]
        for j in stale:
            j["status"] = "pending"
        self._save(*stale)
        return len(stale)

    def counts(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for j in self.jobs:
            out[j["status"]] = out.get(j["status"], 0) + 1
        return out

    def drain(self, backfill, known: set[str]) -> dict[str, int]:
        """Run all jobs: stale ones again first; a label that isn't known or an error fails its job only."""
        self.reset_stale()
        while job := self.claim():
            if job["label"] not in known:
                self.fail(job["job_id"], "label not found")
                continue
            try:
                backfill(job["label"])
            except Exception as e:  # one job's error is kept with the job
                self.fail(job["job_id"], str(e))
            else:
                self.complete(job["job_id"])
        return self.counts()
