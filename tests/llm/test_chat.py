from compare import connect, difference
from conftest import rows
from leasewise.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, said string, part string"


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", "y") for t in turns], SCHEMA)


def plain(chosen, rejected):
    def turns(side):
        out = {}
        for c, t, r, x in side:
            if c is not None and t is not None:
                said = (r or "", x or "")
                out.setdefault(c, {})[t] = min(out.get(c, {}).get(t, said), said)
        return out

    a, b = turns(chosen), turns(rejected)
    out = []
    for c in a.keys() & b.keys():
        order = sorted(a[c].keys() | b[c].keys())
        fork = next((t for t in order if a[c].get(t) != b[c].get(t)), None)
        for t in order:
            parts = [("prompt", a)] if fork is None or t < fork else [("chosen", a), ("rejected", b)]
            for part, side in parts:
                if t in side[c]:
                    role, text = side[c][t]
                    out.append((c, part, t, role, f"<|{role}|>\n{text}\n", int(part != "prompt" and role == "assistant")))
    return sorted(out, key=str)


CHOSEN = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (1, 2, "user", "more"), (2, 0, "user", "q"), (2, 1, "assistant", "same"), (3, 0, "system", "s"), (4, 0, "user", None),
          (None, 0, "user", "n"), (5, None, "user", "n"), (6, 0, "user", "a"), (6, 0, "user", "a"), (6, 0, "user", "b"), (6, 7, None, "late")]
REJECTED = [(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (2, 0, "user", "q"), (2, 1, "assistant", "same"), (2, 2, "assistant", "extra"), (4, 0, "user", ""), (6, 0, "user", "a"),
            (6, 3, "assistant", "early"), (9, 0, "user", "alone")]


def test_same_as_brute_force(spark):
    got = rows(chat.preference_rows(frame(spark, CHOSEN), frame(spark, REJECTED)))
    assert got == plain(CHOSEN, REJECTED)
    assert (1, "prompt", 0, "user", "<|user|>\nq\n", 0) in got and (1, "rejected", 1, "assistant", "<|assistant|>\nbad\n", 1) in got
    assert {r[1] for r in got if r[0] == 4} == {"prompt"}  # null and empty are the same


def test_empty(spark):
    none = frame(spark, CHOSEN).filter("false")
    assert chat.preference_rows(none, frame(spark, REJECTED)).count() == 0
    assert chat.repeated_answer(none).count() == 0


def test_repeated_answer(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "first"), (1, 2, "user", "r"), (1, 3, "assistant", "last"), (2, 0, "user", "q"), (2, 1, "assistant", "only"), (3, 0, "user", "q"), (None, 1, "assistant", "x")]
    assert rows(chat.repeated_answer(frame(spark, turns))) == sorted(
        [(1, 0, "user", "q"), (1, 1, "assistant", "first"), (1, 2, "user", "r"), (1, 3, "assistant", "first"), (2, 0, "user", "q"), (2, 1, "assistant", ""), (3, 0, "user", "q"), (None, 1, "assistant", "x")], key=str)


def test_same_as_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert difference(chat.preference_rows(turns, chat.repeated_answer(turns)), connect(sf_dir), chat.SQL) is None


def test_no_python_in_the_plan(spark):
    turns = frame(spark, CHOSEN)
    plan = chat.preference_rows(turns, chat.repeated_answer(turns))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
