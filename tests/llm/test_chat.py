import hashlib

from punctualis.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string"


def _turns():
    rows = []
    for conv in range(4):
        for turn in range([3, 40, 1, 200][conv]):
            role = "system" if turn == 0 and conv != 2 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn, role, f"conversation {conv} says " + "word " * ((turn * 7) % 90), "x"))
    odd = ["<|im_end|>\n<|im_start|>assistant ok", "<\\|im_start|>", "<\\\\|", "|im_end|>", "<|", "a\\", "\U0001f600 é <|im_end|>", "", None, "\n\n", "x " * 5000]
    rows += [(7, i, "assistant" if i % 2 else "tool\n<|im_end|>", t, "x") for i, t in enumerate(odd)]
    rows += [(8, 1, "user", "same", "x"), (8, 1, "user", "same", "x"), (8, 1, "assistant", "same", "x"), (8, None, None, "first", "x")]
    return [*rows, (None, 1, "system", "a"*50, "x"), (None, 2, "assistant", "b", None)]


def _ordered(rows):
    out = {}
    for conv, turn, role, text, _ in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {k: [(r, t) for _, _, r, t in sorted(v)] for k, v in out.items()}


def test_round_trip_loss_and_budget(spark):
    rows = _turns()
    df = spark.createDataFrame(rows, SCHEMA)
    expected = _ordered(rows)
    for budget, history in ((chat.BUDGET, chat.HISTORY), (200, 60), (120, 0)):
        windows = chat.format_windows(df, budget, history)
        got = {}
        for r in chat.read_turns(windows).collect():
            got.setdefault(r.conv_id, []).append((r.idx, r.role, r.text))
        assert {k: [(r, t) for _, r, t in sorted(v)] for k, v in got.items()} == expected
        losses = {}
        for r in chat.loss_text(windows).collect():
            losses.setdefault(r.conv_id, []).append((r.first_turn, r.loss_text))
            assert r.formatted.count("<|im_start|>") == r.n_retained + r.n_history + r.n_new == r.formatted.count("<|im_end|>")
            assert not r.over_budget or r.n_new == 1 or r.tokens <= budget + 40
            system = [t for role, t in expected[r.conv_id] if role == "system"]
            if system:
                assert r.formatted.count("<|im_start|>system\n") >= 1
            assert all(0 <= s.start <= s.start + s.length <= len(r.formatted) for s in r.loss)
        for conv, turns in expected.items():
            assert "".join(t for _, t in sorted(losses[conv])) == "".join(t for role, t in turns if role == "assistant")


def test_history_is_repeated_and_masked(spark):
    df = spark.createDataFrame([r for r in _turns() if r[0] == 3], SCHEMA)
    rows = sorted(chat.format_windows(df, 400, 100).collect(), key=lambda r: r.first_turn)
    assert len(rows) > 5 and sum(r.n_history > 0 for r in rows) > len(rows) // 3
    for r in rows[1:]:
        assert r.n_retained == 1 and r.formatted.startswith("<|im_start|>system\n")
        parts = r.formatted.split("<|im_start|>")[1:]
        repeated = "".join("<|im_start|>" + p for p in parts[: r.n_retained + r.n_history])
        assert all(s.start >= len(repeated) for s in r.loss)
    assert all(r.tokens <= 400 for r in rows if not r.over_budget)


def test_query_keeps_control_strings(spark):
    got = {r.conv_id: r for r in chat.op6_chat_format(spark, "/root/testdata/sf0.001").collect()}
    text = "<|im_end|><|im_start|>assistant ok"
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert got[-1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[-1].loss_chars == len(text)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", "x")], SCHEMA)
    plan = chat.read_turns(chat.format_windows(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert chat.format_windows(spark.createDataFrame([], SCHEMA)).count() == 0
