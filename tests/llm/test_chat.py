import hashlib
import html
import random

import pytest

from shopspan.llm import chat


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(5)
    marks = ["</turn>", "<turn user>", "&lt;", "&amp;amp;", "\\### Assistant: </turn> ok", "\n", "é🎉", "plain words here ", "<", ">", "&"]
    rows = []
    for c in range(60):
        n = rng.choice([1, 2, 3, 8, 40])
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            rows.append((c, t, role, "".join(rng.choice(marks) for _ in range(rng.choice([0, 3, 30, 300])))))
    rows += [(100, 0, None, None), (100, None, "assistant", "x"), (100, 0, "user", "a"), (100, 0, "user", "a"),
             (101, 0, "system", "only"), (None, 1, "assistant", "nameless"), (102, 5, "user", "y" * 200_000),
             (102, 6, "assistant", "z" * 9000), (102, 7, "system", "late"), (103, 0, "we<ird>&", "t")]
    return rows


def test_read_back_gives_every_turn_once(spark, turns, with_clashes):
    rng = random.Random(1)
    shuffled = rng.sample(turns, len(turns))
    table = with_clashes(spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.read_back(chat.windows(table, budget=300, history=60)).collect()}
    whole = {}
    for c, t, role, text in turns:
        whole.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(whole)
    for c, rows in whole.items():
        rows.sort()
        target = "".join(x for _, role, x in rows if role == "assistant")
        assert got[c].n_turns == len(rows)
        assert got[c].turns_sha256 == digest("".join(f"{role}\n{x}\n" for _, role, x in rows)), c
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(target), digest(target))


def test_windows_by_hand(spark, turns):
    """Window contents from a plain walk over the turns."""
    budget, history = 300, 60
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    esc = lambda x: html.escape(x, quote=False)
    write = lambda t: f"<turn {esc(t[1])}>{esc(t[2])}</turn>\n"
    cost = lambda t: -(-len(esc(t[2])) // 4) + 8
    got = {}
    for r in chat.windows(table, budget, history).collect():
        got.setdefault(r.conv_id, []).append(r)
    whole = {}
    for c, t, role, text in turns:
        whole.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    for c, rows in whole.items():
        rows.sort()
        head = rows[0] if rows[0][1] == "system" else None
        body = rows[1:] if head else rows
        room = max(1, budget - history - (cost(head) if head else 0))
        at, starts, spans = 0, [], []
        for k, t in enumerate(body):
            new_block = not k or at // (16 * room) != starts[-1] // (16 * room)
            if new_block or at + cost(t) - starts[spans[-1][0]] > room:
                spans.append([])
            starts.append(at)
            spans[-1].append(k)
            at += cost(t)
        spans = spans or [[]]
        seen = sorted(got[c], key=lambda r: r.window)
        assert len(seen) == len(spans)
        for r, own in zip(seen, spans):
            past = [k for k, s in enumerate(starts) if own and starts[own[0]] - history <= s < starts[own[0]]]
            lead = ([head] if head and r.window else []) + [body[k] for k in past]
            first = [head] if head and not r.window else []
            shown = lead + first + [body[k] for k in own]
            assert r.formatted == "".join(map(write, shown)) and r.n_repeated == len(lead)
            targets = [esc(t[2]) for t in first + [body[k] for k in own] if t[1] == "assistant"]
            assert [r.formatted[x.start - 1:x.start - 1 + x.length] for x in r.loss] == targets
            if len(own) > 1 or own and cost(body[own[0]]) <= room:
                assert sum(map(cost, shown)) <= budget


def test_a_large_turn_beside_small_ones(spark):
    """A turn of 90 % of the room late in a span, one larger than the room, and many blocks of small turns."""
    sizes = [40, 700, 3160, 40, 40, 9000, 40] + [100 + k % 50 for k in range(3000)]
    rows = [(1, t, ("user", "assistant")[t % 2], "x" * n) for t, n in enumerate(sizes)]
    got = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    tokens = lambda r: [-(-(len(x) - x.index(">") - 1) // 4) + 8 for x in r.formatted.split("</turn>\n")[:-1]]
    passing = [r for r in got if sum(tokens(r)) > chat.BUDGET]
    assert len(passing) == 1 and len(tokens(passing[0])) - passing[0].n_repeated == 1
    # Spans are nearly full: two in a row pass the room.
    whole = sum(-(-n // 4) + 8 for n in sizes)
    assert len(got) <= 1.15 * whole / (chat.BUDGET - chat.HISTORY) + 4


def test_empty_and_native(spark, turns):
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert chat.windows(table.limit(0)).count() == 0 and chat.read_back(chat.windows(table.limit(0))).count() == 0
    plan = chat.read_back(chat.windows(table))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
