import pandas as pd
import pytest

from punctualis.llm import packing
from tests.llm.fixtures import awkward, empty


def _check(rows, counts, lengths):
    bins = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    for pieces in bins.values():
        used = sum(p.n_tokens for p in pieces)
        assert {p.bin_used for p in pieces} == {used}
        assert {p.bin_length for p in pieces} == {min(x for x in lengths if x >= used)}
        at = 0
        for p in sorted(pieces, key=lambda p: p.bin_offset):
            assert p.bin_offset == at
            at += p.n_tokens
    covered = {}
    for r in rows:
        covered.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
    for doc_id, parts in covered.items():
        assert sum(n for _, n in parts) == counts[doc_id]


@pytest.mark.parametrize("group", [7, 20_000])
def test_every_token_is_packed_once(spark, group):
    df = awkward(spark, more=True)
    counts = {}
    for r in df.select("doc_id", packing.token_count(df.text).alias("n")).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + r.n
    for lengths in ((64,), (512, 64, 128)):
        _check(packing.pack(df, lengths=lengths, group=group).collect(), counts, lengths)
    assert packing.pack(empty(spark)).count() == 0


def test_best_fit_choice_and_downsizing():
    def pack(sizes, lengths, overhead=0):
        out = packing.pack_group(pd.DataFrame({"doc_id": range(len(sizes)), "piece": 0, "n_tokens": sizes}), lengths, overhead)
        return {r.doc_id: (r.bin, r.bin_length) for r in out.itertuples()}

    got = pack([7, 6, 4, 3], [10])  # 4 fits both bins' rest no better than into 6
    assert got[0][0] == got[3][0] and got[1][0] == got[2][0]
    assert pack([5], [4, 8, 16]) == {0: (0, 8)}  # cut down to its contents
    assert {length for _, length in pack([3, 3, 3, 3], [4, 16], overhead=8).values()} == {16}
    assert {length for _, length in pack([4, 4, 4], [4, 10]).values()} == {4}  # joint choice: no waste in the short ones
    assert pack([2, 2, 2], [2, 6], overhead=0).keys() == {0, 1, 2}


def test_never_worse_than_any_single_largest_length():
    import random

    pick = random.Random(3)
    lengths, overhead = (32, 64, 128), 4
    for _ in range(20):
        sizes = sorted((pick.randint(1, 32) for _ in range(60)), reverse=True)
        out = packing.pack_group(pd.DataFrame({"doc_id": range(60), "piece": 0, "n_tokens": sizes}), lengths, overhead)
        cost = out.drop_duplicates("bin")["bin_length"].add(overhead).sum()
        for top in lengths:
            alone = packing.pack_group(pd.DataFrame({"doc_id": range(60), "piece": 0, "n_tokens": sizes}), (top,), overhead)
            assert cost <= alone.drop_duplicates("bin")["bin_length"].add(overhead).sum()


def _plain_cost(sizes, lengths, overhead):
    """Least cost of best-fit decreasing over all runs of lengths, every open bin looked at for every piece."""
    costs = []
    for i in range(len(lengths)):
        for j in range(i + 1, len(lengths) + 1):
            allowed = lengths[i:j]
            if allowed[-1] < max(sizes):
                continue
            bins, left = [], sum(sizes)
            for size in sorted(sizes, reverse=True):
                open_bins = [b for b in bins if b[0] - b[1] >= size]
                if open_bins:
                    min(open_bins, key=lambda b: b[0] - b[1])[1] += size
                else:
                    bins.append([min((x for x in allowed if x >= size), key=lambda x: ((x + overhead) / min(x, left), x)), size])
                left -= size
            costs.append(sum(min(x for x in lengths if x >= used) + overhead for _, used in bins))
    return min(costs)


@pytest.mark.parametrize("group", [40, 20_000])
def test_against_plain_best_fit(spark, group):
    import random

    pick, lengths, overhead = random.Random(group), (16, 32, 64), 4
    rows = [(n % 90, " ".join(["w"] * pick.choice([0, 3, 9, 20, 33, 70, 200]))) for n in range(150)]
    df = spark.createDataFrame(rows + [(None, None)], "doc_id bigint, text string")
    out = packing.pack(df, lengths, overhead, group).collect()
    sizes = [n for _, t in rows for n in [len(t.split()) + 1]] + [1]
    assert sorted(r.n_tokens for r in out) == sorted(min(64, n - at) for n in sizes for at in range(0, n, 64))
    groups = {}
    for r in out:
        groups.setdefault(r.bin_id >> 32, []).append(r)
    assert len(groups) == 1 if group > 1000 else len(groups) > 3
    for packed in groups.values():
        cost = sum(length + overhead for length in {r.bin_id: r.bin_length for r in packed}.values())
        assert cost == _plain_cost([r.n_tokens for r in packed], lengths, overhead)


def test_equal_rows_are_spread(spark):
    df = spark.range(3000).selectExpr("1L AS doc_id", "'one two' AS text")
    sizes = [r["count"] for r in packing.pack(df, (16, 32), 4, 100).selectExpr("bin_id >> 32 AS g").groupBy("g").count().collect()]
    assert sum(sizes) == 3000 and len(sizes) > 20 and max(sizes) < 200
