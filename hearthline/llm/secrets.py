"""Secrets in texts, told apart from examples by who owns them across the whole corpus.

Candidates are found by pattern; each is named by a hash of its secret part, a private key by its whole body.
Over all documents the distinct repositories and owners of each hash are counted. A value that many owners share is an example
that has been copied; a high-entropy value of one owner looks live. Beyond the base patterns, looser ones
propose further candidates, which count only when their ownership makes them look live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import map_batches, small_batches
from hearthline.session import written

# The base kinds in their order, and looser ones.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MORE = {
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "slack": re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    "google": re.compile(r"AIza[A-Za-z0-9_-]{35}"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "private_key": re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),  # the secret is what key_body finds after it
}
HINTS = {"github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "slack": ("xox",), "google": ("AIza",), "jwt": ("eyJ",),
         "private_key": ("-----BEGIN ",)}
KEY_MARKS = re.compile(r"""\\+[nrt]|["'`]\s*\+|["'`,>|#*\\]""")  # line ends that are escaped, quoting and joining of lines
KEY_LINES = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}(?:\s+[A-Za-z0-9+/]{16,}={0,2})*(?:\s+[A-Za-z0-9+/]+={1,2}(?![A-Za-z0-9+/=]))?")
NOT_KEY = re.compile("[^A-Za-z0-9+/=]+")
KEYWORDS = re.compile("password|passwd|secret|token|api_?key", re.I | re.A)

MANY_OWNERS = 3  # distinct owners from which a value is an example
LIVE_BITS = 3.0  # entropy a character of a value that looks live
HOT_SHARE = 1000  # a hash with more than one in so many candidates is joined by broadcast: there are fewer than that


def key_body(text: str, at: int) -> str:
    """The base64 of the private key whose header ends at ``at``, whole and however its lines are cut and quoted.

    Without an end mark, as in a text that was cut, it is the first run of long base64 lines. Empty where only
    the header is named.
    """
    stop = text.find("-----", at)
    body = KEY_MARKS.sub(" ", text[at:stop if stop >= 0 else len(text)])
    if stop < 0 or not text.startswith("-----END", stop):
        lines = KEY_LINES.search(body)
        body = lines[0] if lines else ""
    return NOT_KEY.sub("", body)


def find_secrets(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, secret) by start, base kinds first; ends are exclusive, in code points."""
    found = []
    if KEYWORDS.search(text):
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    for kind, pattern in MORE.items():
        if any(h in text for h in HINTS[kind]):
            found += [(kind, m.start(), m.end(), key_body(text, m.end()) if kind == "private_key" else m[0])
                      for m in pattern.finditer(text)]
    found = [x for x in found if x[3]]
    order = {k: n for n, k in enumerate((*BASE, *MORE))}
    return sorted(found, key=lambda x: (x[1], order[x[0]]))


def entropy(secret: str) -> float:
    """Bits a character."""
    return -sum(n / len(secret) * math.log2(n / len(secret)) for n in Counter(secret).values())


def spans_text(spans) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


_FOUND = ("doc_id long, row long, owner string, repository string, "
          "found array<struct<kind:string,start:long,stop:long,hash:string,bits:double>>")


def _candidates(docs: DataFrame) -> DataFrame:
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [[{"kind": k, "start": a, "stop": z, "hash": hashlib.md5(s.encode()).hexdigest(), "bits": entropy(s)}
                  for k, a, z, s in find_secrets(t or "")] for t in b["text"].to_pylist()]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                                   ("hash", pa.string()), ("bits", pa.float64())]))
        return pa.RecordBatch.from_pydict({**{c: b[c] for c in ("doc_id", "row", "owner", "repository")},
                                           "found": pa.array(found, kind)})
    return map_batches(docs, batch, _FOUND)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n, repositories, owners) of ``candidates`` (hash, owner, repository); a null name is a name of its own.

    Copies collapse before the shuffle: first by hash, owner and repository, then by hash.
    """
    each = candidates.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = each.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n"), F.sum("repositories").alias("repositories"),
                                        F.count("*").alias("owners"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str | None = None, many_owners: int = MANY_OWNERS,
                 live_bits: float = LIVE_BITS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, <owner>, <repository>), with its secrets and what they are.

    (doc_id, n_assign, n_access, n_hex, base, spans, n_live, n_example, secrets): ``base`` and ``spans`` are
    texts kind:start:end, joined by commas, of the base matches and of all. ``secrets`` has for each span its
    hash, distinct owners and repositories in the whole corpus, and a verdict: ``example`` with ``many_owners``
    or more owners, else ``live`` with ``live_bits`` of entropy a character, else ``weak``. Base matches always
    stay; those of other kinds only if live. Without a repository column the owner's name counts as one.
    A null text has no secrets; null owners count as one owner. Repeated rows and ids are kept, and other
    columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text",
                       F.col(owner).cast("string").alias("owner"),
                       F.col(repository or owner).cast("string").alias("repository"))
    found = written(_candidates(rows), "secrets")
    each = found.select("row", "owner", "repository", F.inline("found"))
    owned = written(ownership(each), "owners")
    total = owned.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * HOT_SHARE > total  # fewer than HOT_SHARE hashes, so the broadcast is bounded
    hot = F.broadcast(owned.where(often).select("hash", F.col("owners").alias("hot_owners"), F.col("repositories").alias("hot_repositories")))
    split = each.select("row", "kind", "start", "stop", "hash", "bits").join(hot, "hash", "left")
    columns = ["row", "kind", "start", "stop", "hash", "bits", "owners", "repositories"]
    judged = (split.where("hot_owners IS NOT NULL").withColumnsRenamed({"hot_owners": "owners", "hot_repositories": "repositories"})
              .select(columns)
              .union(split.where("hot_owners IS NULL").drop("hot_owners", "hot_repositories")
                     .join(owned.where(~often).drop("n"), "hash").select(columns)))
    verdict = F.when(F.col("owners") >= many_owners, "example").when(F.col("bits") >= live_bits, "live").otherwise("weak")
    ranks = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {n}" for n, k in enumerate((*BASE, *MORE))) + " END")
    kept = judged.withColumn("verdict", verdict).where(F.col("kind").isin(*BASE) | (F.col("verdict") == "live"))
    secrets = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", ranks.alias("rank"), "stop", "kind", "hash", "owners", "repositories", "verdict"))).alias("secrets"))
    joined = found.select("doc_id", "row").join(secrets, "row", "left").withColumn(
        "secrets", F.expr("coalesce(secrets, filter(array(named_struct('start', 0L, 'rank', 0, 'stop', 0L, 'kind', '', "
                          "'hash', '', 'owners', 0L, 'repositories', 0L, 'verdict', '')), x -> false))"))
    text = "concat_ws(',', transform({}, x -> concat(x.kind, ':', x.start, ':', x.stop)))"
    base = f"filter(secrets, x -> x.rank < {len(BASE)})"
    count = "cast(size(filter(secrets, x -> {})) AS long)"
    return joined.selectExpr(
        "doc_id", *(f"{count.format(f'x.kind = {k!r}')} AS n_{k}" for k in BASE),
        f"{text.format(base)} AS base", f"{text.format('secrets')} AS spans",
        *(f"{count.format(f'x.verdict = {v!r}')} AS n_{v}" for v in ("live", "example")),
        "transform(secrets, x -> named_struct('kind', x.kind, 'start', x.start, 'stop', x.stop, 'hash', x.hash, "
        "'owners', x.owners, 'repositories', x.repositories, 'verdict', x.verdict)) AS secrets")
