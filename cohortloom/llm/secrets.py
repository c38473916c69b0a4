"""Secrets in texts, told apart by how widely each candidate is owned.

Candidates are found by fixed patterns (``assign``, ``access``, ``hex``: the base)
and by wider ones (``WIDER``). A hash of each candidate's value is counted over
distinct repositories and owners in the whole corpus. Each span is then classed: a
value that one owner alone has is a live-looking credential however often that owner
repeats it, and so is one that at most ``max_owners`` owners and ``max_repos``
repositories have; any other is an example that was copied. Base spans always
stay, with their class; a wider candidate adds its span only if it is live.

All patterns take time in proportion to the text, very long ones too: none begins with
a repeated class that its own matches could begin in. Null and empty texts have no
spans. A null owner or repository counts as one of its own. Rows are told apart by a
row number of their own, so repeated rows give repeated results; columns that are not
named are ignored, whatever they are called. An empty table gives an empty result.
Spans are in code points, the end exclusive.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import cut, more, slices, spread_join

#: The base patterns; kind, pattern, least length, group measured, prefilter.
BASE = (
    ("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, r"(?i:password|passwd|secret|token|api_?key)"),
    ("access", r"AKIA[A-Z0-9]+", 18, 0, r"AKIA"),
    ("hex", r"[0-9a-f]+", 16, 0, r"[0-9a-f]{16}"),
)
#: Further public credential formats.
WIDER = (
    ("bearer", r"[bB][eE][aA][rR][eE][rR]\x20+([A-Za-z0-9+/_.=-]{16,})", 16, 1, r"(?i:bearer )"),
    ("github", r"gh[pousr]_[A-Za-z0-9]{30,}", 34, 0, r"gh[pousr]_"),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, 0, r"eyJ"),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15, 0, r"xox[abprs]-"),
    ("google", r"AIza[0-9A-Za-z_-]{35}", 39, 0, r"AIza"),
    ("stripe", r"[rs]k_live_[0-9A-Za-z]{24,}", 32, 0, r"[rs]k_live_"),
    ("private", r"-----BEGIN (?:[A-Z]{2,10} )?PRIVATE KEY-----\s+([A-Za-z0-9+/=]{32,})", 32, 1, r"PRIVATE KEY-----"),
    ("userinfo", r"://[^\s/:@]+:([^\s/:@]{8,})@", 8, 1, r"://[^\s/:@]+:"),
    ("assigned", r"""(?:pwd|auth|credential|private_?key|access_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})""", 12, 1, r"(?:pwd|auth|credential|private_?key|access_?key)"),
)
KINDS = [k for k, *_ in BASE + WIDER]
_COMPILED = [(kind, re.compile(pattern), least, group, fast) for kind, pattern, least, group, fast in BASE + WIDER]


def find(text: str, kinds) -> list[tuple[int, int, int, bool, str]]:
    """Spans of one text: start, end, kind's place, whether it is a wider kind, value."""
    out = []
    for k in kinds:
        _, pattern, least, group, _ = _COMPILED[k]
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                out.append((m.start(), m.end(), k, k >= len(BASE), m[group]))
    return sorted(out)


def _scan(batches):
    fields = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("wider", pa.bool_()), ("value", pa.string())])
    for batch in slices(batches):
        texts = batch.column("text")
        hits = np.stack([pc.fill_null(pc.match_substring_regex(texts, fast), False).to_numpy(zero_copy_only=False) for *_, fast in _COMPILED], axis=1)
        spans: list = [[]] * batch.num_rows
        for i in np.flatnonzero(hits.any(axis=1)):
            spans[i] = [dict(zip(("start", "end", "kind", "wider", "value"), x)) for x in find(texts[int(i)].as_py(), np.flatnonzero(hits[i]).tolist())]
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(spans, pa.list_(fields))], names=[*names, "spans"])


def candidates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """Per document: doc_id, repo, owner and an array of candidate spans with a hash of the value (never the value)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(repo_col).cast("string"), F.lit("\0")).alias("repo"), F.coalesce(F.col(owner_col).cast("string"), F.lit("\0")).alias("owner"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_scan, more(rows.drop("text"), "spans array<struct<start:long,end:long,kind:int,wider:boolean,value:string>>"))
    return found.withColumn("spans", F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["wider"].alias("wider"), F.xxhash64(x["value"]).alias("h"))))


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each candidate hash in the corpus: h, n_repos, n_owners, n_seen."""
    each = found.select("repo", "owner", F.explode("spans").alias("s")).select("repo", "owner", F.col("s.h").alias("h"))
    pairs = each.groupBy("h", "owner", "repo").agg(F.count("*").alias("n"))
    owners = pairs.groupBy("h", "owner").agg(F.count("*").alias("r"), F.sum("n").alias("n"))
    by_owner = owners.groupBy("h").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_seen"))
    by_repo = pairs.groupBy("h", "repo").agg(F.count("*").alias("o")).groupBy("h").agg(F.count("*").alias("n_repos"))
    return by_owner.join(by_repo, "h")


def scan(docs: DataFrame, max_owners: int = 2, max_repos: int = 5, **columns) -> DataFrame:
    """Per document: doc_id, spans (start, kind, end, wider, h, n_owners, n_repos, live); wider spans only if live."""
    found = cut(candidates(docs, **columns).withColumn("row", F.monotonically_increasing_id()))
    each = found.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    judged = spread_join(each, cut(ownership(found)), ["h"], "n_seen")
    live = (F.col("n_owners") == 1) | ((F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos))
    kept = judged.withColumn("live", live).where("live or not wider").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "wider", "h", "n_owners", "n_repos", "live"))).alias("judged"))
    return found.select("row", "doc_id").join(kept, "row", "left").select("doc_id", F.col("judged").alias("spans"))


def kind_name(kind):
    return F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)
