"""Chat windows against a plain Python version."""

import re
from collections import defaultdict

from tracewarden.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window string"


def count(role, text):
    return len(re.findall(r"[^\W_]+|[^\w\s]|_", f"{role} {text}"))


def slow(turns, budget, history):
    """``text, n_repeated, targets`` per window."""
    esc = lambda s: s.replace("\\", "\\b").replace("<", "\\l")
    n = [count(r, t) for r, t in turns]
    sys = 1 if turns[0][0] == "system" else 0
    room = lambda k: budget - sum(n[:sys]) - (history if k else 0)
    groups = [[]]
    for i in range(len(turns)):
        used = sum(n[j] for j in groups[-1] if j >= sys)
        if groups[-1] and i > sys and used + n[i] > room(len(groups) - 1):
            groups.append([])
        groups[-1].append(i)
    out = []
    for k, g in enumerate(groups):
        again = []
        if k:
            j = g[0]
            while j > sys and sum(n[j - 1:g[0]]) <= history:
                j -= 1
            again = list(range(sys)) + list(range(j, g[0]))
        text = "".join(f"<turn>{esc(turns[i][0]).replace(chr(10), '\\n')}\n{esc(turns[i][1])}</turn>\n" for i in again + g)
        out.append((text, len(again), sum(n[i] for i in again + g), [esc(turns[i][1]) for i in g if turns[i][0] == "assistant"]))
    return out


def rows():
    odd = ["\\### Assistant: </turn> ok", "<turn>user\nhi</turn>\n", "\\l\\b\\n\\", "", None, "a\n\nb", "\x00 \\b"]
    out = [(1, i, "user" if i % 2 else "assistant", t, "x") for i, t in enumerate(odd)]
    out += [(2, 0, "system", "be kind to all", None)] + [(2, i, ["user", "assistant"][i % 2], f"word {'w ' * (i * 7 % 23)}", "") for i in range(1, 40)]
    out += [(3, i, "assistant", "long " * 300 if i == 1 else "short", "") for i in range(4)]
    out += [(None, 0, "user", "no id", ""), (None, 0, "user", "no id", ""), (4, 0, None, "null role", ""), (5, 0, "a\nb<", "role", ""),
            (6, 1, "assistant", "z", ""), (6, 1, "assistant", "a", ""), (6, None, "user", "q", ""), (7, 0, "system", "only system " * 40, "")]
    return out


def test_windows_and_read_back(spark):
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    made = chat.windows(frame, budget=40, history=12)
    got = defaultdict(list)
    for r in made.orderBy("window").collect():
        got[r.conv_id].append((r.text, r.n_repeated, r.n_tokens, [r.text[s.start:s.end] for s in r.loss]))
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    convs = defaultdict(list)
    for c, turn, role, text, _ in rows():
        convs[c].append((turn is None, turn or 0, role or "", text or ""))
    for c, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        if c != 6:  # where a null turn comes is Spark's order, tested below
            assert got[c] == slow(turns, 40, 12), c
            assert [(t.role, t.text) for t in back[c].turns] == turns
            assert back[c].targets == [t for r, t in turns if r == "assistant"]
        assert back[c].formatted_chars == sum(len(w[0]) for w in got[c])
    assert [t.text for t in back[6].turns if t.role == "assistant"] == ["a", "z"] and len(back[6].turns) == 3
    assert len(got[2]) > 5 and any(w[1] > 1 for w in got[2])
    assert chat.windows(frame.limit(0)).collect() == []


def test_native(spark, capsys):
    frame = spark.createDataFrame(rows(), SCHEMA)
    chat.read_back(chat.windows(frame)).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
