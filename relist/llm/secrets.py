"""Secret scan over an incremental blob ledger.

Every version of a text is a blob, addressed by the SHA-256 of its UTF-8
bytes.  The ledger is a Parquet table of (blob, rule version, findings) in a
shared folder.  A run hashes the given paths, takes the distinct blobs, drops
the (blob, rule version) pairs the ledger already holds, scans only the rest
(each blob once, whichever path it came from), appends what it found, and
joins the findings back to all paths.  A new rule version scans every blob
again and leaves the older findings in place.

Findings are (kind, start, end) in code points, end exclusive.  The base
kinds ``assign``, ``access`` and ``hex`` follow fixed patterns; the other
kinds are added by this operator.

Defined cases: a null text is the empty blob; an empty table gives an empty
result; repeated rows each get the findings; a path with several texts has a
blob for each; of two findings at one place the kind listed first comes first;
texts of any length are scanned whole, in time that grows with their length;
columns of the input other than the path and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

# fixed values: the base kinds and their least lengths
ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")   # a maximal run, so the same as dropping shorter ones
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
BASE = ("assign", "access", "hex")

# added kinds, in the order they are listed; each can begin at the start of a
# run of its characters only, so a text is passed once however it is made up
EXTRA = (
    ("private_key", re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")),
    ("bearer", re.compile(r"\b[Bb]earer\x20+[A-Za-z0-9_.~+/-]{20,}=*")),
    ("jwt", re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("url_login", re.compile(r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{0,30}://[^\s/:@]+:[^\s/@]+@")),
)
RULES = "base+extra/2"
LEDGER = "blob string, rules string, n_assign long, n_access long, n_hex long, base string, spans string"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base findings, by start and kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def extra_spans(text: str) -> list[tuple[int, int, int]]:
    found = []
    for k, (name, pattern) in enumerate(EXTRA, len(BASE)):
        if {"private_key": "-----BEGIN ", "bearer": "earer ", "jwt": "eyJ", "url_login": "://"}[name] in text:
            found += [(m.start(), k, m.end()) for m in pattern.finditer(text)]
    return found


def _join(spans: list[tuple[int, int, int]]) -> str:
    names = [*BASE, *(n for n, _ in EXTRA)]
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)


def scan_text(text: str) -> tuple[int, int, int, str, str]:
    base = base_spans(text)
    kinds = [k for _, k, _ in base]
    return kinds.count(0), kinds.count(1), kinds.count(2), _join(base), _join(sorted(base + extra_spans(text)))


def _scan_batches(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for b in batches:
        rows = [scan_text(t or "") for t in b.column("text").to_pylist()]
        cols = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [b.column("blob"), b.column("rules")] + [pa.array(cols[i], pa.int64()) for i in range(3)]
            + [pa.array(cols[i], pa.string()) for i in (3, 4)],
            names=["blob", "rules", "n_assign", "n_access", "n_hex", "base", "spans"])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, or an empty one where none has been written yet."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def scan(versions: DataFrame, ledger_path: str, path_col: str = "path", text_col: str = "text",
         rules: str = RULES) -> DataFrame:
    """One row per input row: the path, its blob and the findings.

    Pairs that the ledger lacks are scanned and appended first.  The append
    is a Spark write, so a lost executor only repeats its tasks, and a pair
    written twice by two concurrent runs is read once."""
    spark = versions.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = versions.select(F.col(f"`{path_col}`").alias(path_col), text.alias("text")) \
        .withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    paths = materialise(rows.select(path_col, "blob"), "blobs")
    seen = read_ledger(spark, ledger_path).where(F.col("rules") == rules).select("blob").distinct()
    # one path stands for each unseen blob, so its text travels once and a blob with very many paths is no hot key;
    # a path may have several texts, so a row is taken by its path and its blob
    work = (paths.join(seen, "blob", "left_anti").groupBy("blob").agg(F.min(path_col).alias("__from"))
            .select(F.col("blob").alias("__blob"), "__from").hint("shuffle_hash"))
    (rows.join(work, F.col(path_col).eqNullSafe(F.col("__from")) & (F.col("blob") == F.col("__blob")))
     .select("blob", F.lit(rules).alias("rules"), "text").mapInArrow(_scan_batches, LEDGER)
     .write.mode("append").parquet(ledger_path))
    known = (spark.read.schema(LEDGER).parquet(ledger_path).where(F.col("rules") == rules).drop("rules")
             .dropDuplicates(["blob"]))
    return paths.join(known, "blob")
