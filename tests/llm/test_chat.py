import hashlib
import random
from collections import defaultdict

import pytest
from conftest import prose

from tarmac.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def heard(windows):
    out = defaultdict(list)
    for r in sorted(chat.read_windows(windows).collect(), key=lambda r: r.window):
        out[r.conv_id].append(([tuple(t) for t in r.turns], r.loss_text))
    return out


def conversations(seed, count, longest):
    draw, rows = random.Random(seed), []
    controls = ["<turn ", "</turn>", "\\", "\\t", "\\s", "\\e", ">\n", "</turn>\n", "<turn user>\n", "### Assistant:", ""]
    for c in range(count):
        n = draw.randint(1, longest)
        system = draw.random() < 0.4
        for t in range(n):
            role = "system" if system and t == 0 else ["user", "assistant"][t % 2]
            text = prose(c * 1000 + t, draw.choice([0, 3, 20, 200])) + draw.choice(controls) + draw.choice(controls)
            rows.append((c, t, role, text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [256, 3])
def test_every_turn_once_and_within_budget(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    rows = conversations(block, 40, 30)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    windows = chat.format_windows(df, budget=400, history_tokens=100)
    by = defaultdict(list)
    for c, t, role, text in sorted(rows):
        by[c].append((role, text))
    for c, parts in heard(windows).items():
        assert [t for new, _ in parts for t in new] == by[c]
        assert "".join(loss for _, loss in parts) == "".join(t for r, t in by[c] if r == "assistant")
    tokens = lambda t: -(-len(t.encode()) // 4) + 4
    for r in windows.collect():
        marks = r.formatted.count("</turn>\n")
        assert marks == r.n_context + r.n_new and r.formatted.count("<turn ") == marks
        system = by[r.conv_id][0][0] == "system"
        half = max(1, (300 - (tokens(by[r.conv_id][0][1]) if system else 0)) // 2)
        assert r.n_tokens <= 400 or r.n_new <= 2 or half < 8
        if r.window > 0 and system:
            assert r.formatted.startswith("<turn system>\n" + by[r.conv_id][0][1].replace("\\", "\\s").replace("</turn", "\\e").replace("<turn", "\\t"))
        if r.window > 0:
            repeats = r.n_context - system
            before = by[r.conv_id][int(system) : r.window][::-1][:2]
            want, used = 0, 0
            for _, text in before:
                used += tokens(text)
                if used > 100:
                    break
                want += 1
            assert repeats == want


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "a"),
        (None, 1, "assistant", "b"),
        (1, None, None, None),
        (1, 0, "assistant", None),
        (2, 0, "system", "only this"),
        (3, 5, "user", "same"),
        (3, 5, "user", "same"),
        (4, 0, "we>ird\n</turn>", "x"),
        (5, 0, "assistant", prose(1, 50_000)),
        (5, 1, "user", "short"),
    ]
    got = heard(chat.format_windows(spark.createDataFrame(rows, SCHEMA)))
    new = {c: [t for n, _ in parts for t in n] for c, parts in got.items()}
    assert new[None] == [("user", "a"), ("assistant", "b")]
    assert new[1] == [("", ""), ("assistant", "")]
    assert new[2] == [("system", "only this")] and new[3] == [("user", "same")] * 2
    assert new[4] == [("we>ird\n</turn>", "x")]
    assert new[5] == [("assistant", prose(1, 50_000)), ("user", "short")] and got[5][0][1] == prose(1, 50_000)
    assert chat.format_windows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_extra_columns_with_clashing_names(spark):
    schema = SCHEMA + ", window int, tokens string, place double, cell int, conv string"
    df = spark.createDataFrame([(1, 0, "user", "a", 1, "x", 0.5, 2, "y"), (1, 1, "assistant", "b", None, None, None, None, None)], schema)
    assert [t for n, _ in heard(chat.format_windows(df))[1] for t in n] == [("user", "a"), ("assistant", "b")]


def test_probe_conversation(spark, folder):
    from tarmac.llm.queries import QUERIES

    row = QUERIES["op4_chat_windows"](spark, folder).where("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(said)
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
