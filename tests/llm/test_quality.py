from punctualis.llm import quality as q
from tests.llm.fixtures import awkward, awkward_rows, empty, words_of


def _measure(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    wins = {}
    for i in range(len(words) - 7):
        wins.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + j for at in wins.values() if len(at) > 1 for i in at for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures_against_plain_python(spark):
    rows = [*awkward_rows(), (50, "a # b\n" * 9 + "a # b", "en", "h1", 0), (51, "%%% ***\n\n%%% ***\n \n", None, "h1", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_words bigint")
    got = q.measure(df).collect()
    assert sorted(((r.doc_id, *(r[m] for m in q.MEASURES)) for r in got), key=repr) == sorted(((r[0], *_measure(r[1])) for r in rows), key=repr)


def test_bad_host_goes_and_small_hosts_are_shrunk(spark):
    good = "The words of a plain document that goes on for a while without repeats, number {} of its kind here, fine and long enough now"
    bad = "# {} # * $ a b c d e f g h i j k l m n o p q r s t u v w x y"
    rows = [(i, good.format(i), f"good{i % 5}") for i in range(200)] + [(1000 + i, bad.format(i), "bad") for i in range(60)]
    rows += [(2000, bad.format(1), "tiny"), (2001, good.format(2), "bad"), (2002, good.format(3), None)]
    got = {r.doc_id: r for r in q.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert all(got[i].kept for i in range(200)) and got[2002].kept
    assert not got[2001].kept and not got[2001].base_failed  # its host is rejected
    assert not got[1000].kept
    verdict = {r.host: r for r in q.host_verdicts(q.measure(spark.createDataFrame(rows, "doc_id bigint, text string, source string")), q.F.col("source")).collect()}
    assert verdict["tiny"].symbols_rate < 1.0 and verdict["bad"].symbols_rate > 0.9


def test_awkward_rows(spark):
    df = awkward(spark, more=True)
    got = q.judge(df)
    assert got.count() == df.count()
    assert all(not r.kept for r in got.collect() if r.base_failed)
    assert q.judge(empty(spark)).count() == 0
