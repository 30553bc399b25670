"""Best-fit packing into sequences of several permitted lengths.

Texts are counted in tokens (an estimate: runs of ASCII letters and digits, single other non-blank characters, and
one end mark per text). Texts longer than the longest sequence are cut into pieces that cover them whole. Pieces are
dealt to groups of about ``GROUP`` pieces by a hash of their row and of its number in the stored table, so equal rows spread
like others; there are as many groups as the data need, and each is packed by itself:
longest piece first, into the open bin with the least room that still fits. Where none fits, the bin size is
opened that costs least per token it can expect to hold (its own piece and what is left of the group). This is
tried with every run of permitted lengths, the plan of least total cost is taken, and each bin is at last cut down to
the shortest permitted length that holds its contents.

Defined results: NULL and empty texts are one token (the end mark); repeated rows are packed as often as they occur;
ties are ordered by id and piece; a NULL id is packed like any other; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.llm.shared import stored, table

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 32
GROUP = 20_000
TOKEN = r"[0-9A-Za-z]+|[^0-9A-Za-z \t\n\r]"
PACKED_SCHEMA = "doc_id bigint, piece bigint, first_token bigint, n_tokens bigint, bin_id bigint, bin_length bigint, bin_used bigint, bin_offset bigint"


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("bigint") + 1


def _place(sizes: Sequence[int], lengths: Sequence[int], overhead: int) -> tuple[list[int], list[int]]:
    """Bin of each piece (sizes falling) and the tokens in each bin. ``rooms`` has a bit for every room some bin has."""
    top = lengths[-1]
    by_room: list[list[int]] = [[] for _ in range(top + 1)]
    rooms, used, places = 0, [], []
    left = sum(sizes)
    for size in sizes:
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room = min((x for x in lengths if x >= size), key=lambda x: ((x + overhead) / min(x, left), x))
            chosen = len(used)
            used.append(0)
        used[chosen] += size
        places.append(chosen)
        left -= size
        room -= size
        if room:
            by_room[room].append(chosen)
            rooms |= 1 << room
    return places, used


def pack_group(pieces: pd.DataFrame, lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD) -> pd.DataFrame:
    """Pack one group; adds bin (number in the group), bin_length, bin_used and bin_offset."""
    pieces = pieces.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
    sizes = pieces["n_tokens"].tolist()
    shrunk = lambda n: next(x for x in lengths if x >= n)
    choices = [lengths[i:j] for j in range(1, len(lengths) + 1) for i in range(j) if not sizes or lengths[j - 1] >= sizes[0]]
    plans = [_place(sizes, choice, overhead) for choice in choices]
    places, used = min(plans, key=lambda plan: sum(shrunk(n) + overhead for n in plan[1]))
    out = pieces.assign(bin=places)
    out["bin_length"] = [shrunk(used[b]) for b in places]
    out["bin_used"] = [used[b] for b in places]
    out["bin_offset"] = out.groupby("bin", sort=False)["n_tokens"].cumsum() - out["n_tokens"]
    return out


def pack(docs: DataFrame, lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD, group: int = GROUP) -> DataFrame:
    """One row per piece (PACKED_SCHEMA). Only ids and token counts are shuffled."""
    lengths = tuple(sorted(lengths))
    top = lengths[-1]
    counts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), token_count(F.col("text")).alias("n"), F.xxhash64("text").alias("h"))
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / top)))
    pieces = counts.withColumn("piece", starts).select(
        "doc_id", "piece", (F.col("piece") * top).alias("first_token"), F.least(F.lit(top), F.col("n") - F.col("piece") * top).alias("n_tokens"), "h"
    )
    pieces = stored(pieces.withColumn("row_no", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", "h", "row_no"), F.lit(groups))).drop("h", "row_no")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        packed = pack_group(rows, lengths, overhead)
        packed["bin_id"] = packed["pack_group"] * (1 << 32) + packed["bin"]
        return packed[["doc_id", "piece", "first_token", "n_tokens", "bin_id", "bin_length", "bin_used", "bin_offset"]]

    return dealt.groupBy("pack_group").applyInPandas(run, PACKED_SCHEMA)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op3_best_fit_packing": op3_best_fit_packing}
SQL: dict[str, str] = {}
