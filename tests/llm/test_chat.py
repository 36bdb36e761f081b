import hashlib
import random

from pyspark.sql import functions as F

from fipsight.llm.chat import format_conversations, format_turns, parse, read_back

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def brute(rows):
    convs = {}
    for c, t, r, x, _ in rows:
        convs.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, v in convs.items():
        v.sort()
        said = "".join(f"{r}\n{x}\n" for _, r, x in v)
        loss = "".join(x for _, r, x in v if r == "assistant")
        out[c] = (len(v), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip_of_hostile_turns(spark):
    random.seed(5)
    bits = ["<|im_end|>", "<|im_start|>", "assistant", "user", "\n", "<", "|", "\\", "<\\|", "<|", "x", "é日", "%0A", "%", ""]
    rows = []
    for c in range(60):
        for t in range(random.randrange(1, 6)):
            text = "".join(random.choice(bits) for _ in range(random.randrange(0, 9)))
            role = random.choice(["user", "assistant", "assistant", "sys\ntem", "a<|b", "100%", "", None])
            rows.append((c, t, role, random.choice([text, text, text, None]), "clash"))
    rows += [(None, 0, "user", "lost", ""), (None, None, "assistant", "first", ""), (3, 0, "user", "tie", ""),
             (3, 0, "user", "tie", "")]
    df = format_conversations(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: r for r in read_back(df).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for c, w in want.items():
        r = got[c]
        assert r.round_trip and (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == w


def test_only_conflicting_turns_are_escaped(spark):
    rows = [(1, 0, "user", "plain < | \\ text", ""), (1, 1, "assistant", "<|im_end|>", ""), (1, 2, "user", "<|odd", "")]
    got = {r.turn: r.rendered for r in format_turns(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == "<|im_start|>user\nplain < | \\ text<|im_end|>\n"
    assert got[1] == "<|im_start|>assistant\n<\\|im_end|><|im_end|>\n"
    assert got[2] == "<|im_start|>user\n<|odd<|im_end|>\n"  # comes back as it is


def test_parser_refuses_broken_text(spark):
    bad = ["x", "<|im_start|>user\nhi", "<|im_start|>user<|im_end|>\n", "<|im_start|>u\na<|im_end|>b<|im_end|>\n"]
    df = spark.createDataFrame([(b,) for b in bad], "f string").select(parse(F.col("f")).alias("p"))
    assert all(r.p is None for r in df.collect())


def test_empty_table(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
