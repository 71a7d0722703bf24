"""Preference pairs against plain Python."""

import random

from tablefolio.llm import preference

TURNS = "pair_id long, turn long, role string, text string, pos string, side string"
CONV = "conv_id long, turn long, role string, text string, pair string"


def safe(text):
    return text.replace("<|", "< |").replace("|>", "| >")


def brute(chosen, rejected):
    def sides(rows):
        out = {}
        for p, t, r, x in sorted(((p, (t is not None, t or 0), r or "", x or "") for p, t, r, x in rows if p is not None)):
            out.setdefault(p, []).append((r, x))
        return out

    a, b, out = sides(chosen), sides(rejected), {}
    for p in a.keys() & b.keys():
        n = 0
        while n < min(len(a[p]), len(b[p])) and a[p][n] == b[p][n]:
            n += 1
        made = [n, "".join(f"<|im_start|>{safe(r)}\n{safe(x)}<|im_end|>\n" for r, x in a[p][:n])]
        for side in (a[p][n:], b[p][n:]):
            text, spans = "", []
            for r, x in side:
                turn = f"<|im_start|>{safe(r)}\n{safe(x)}<|im_end|>\n"
                if r == "assistant":
                    spans.append((len(text) + turn.index("\n") + 1, len(text) + len(turn) - 1))
                text += turn
            made += [text, spans]
        out[p] = tuple(made)
    return out


def pairs(spark, chosen, rejected):
    sides = [spark.createDataFrame([(*r, "x", "x") for r in rows], TURNS) for rows in (chosen, rejected)]
    return {r.pair_id: (r.n_prompt_turns, r.prompt, r.chosen_completion, [tuple(s) for s in r.chosen_trained],
                        r.rejected_completion, [tuple(s) for s in r.rejected_trained])
            for r in preference.preference_pairs(*sides).collect()}


def test_as_brute_force(spark):
    rng = random.Random(5)
    chosen, rejected = [], []
    for p in range(60):
        shared = [(rng.choice(["user", "assistant", "system", None]), rng.choice(["a", "é😀", "", None, "<|im_end|>", "x\ny"]))
                  for _ in range(rng.randint(0, 5))]
        for rows in (chosen, rejected):
            own = [(rng.choice(["user", "assistant"]), rng.choice(["p", "q", "r<|s|>", None])) for _ in range(rng.randint(0, 3))]
            rows += [(p, k, r, x) for k, (r, x) in enumerate(shared + own)]
    chosen += [(None, 0, "user", "a"), (70, 0, "user", "only here"), (71, None, "user", "a"), (71, 1, "assistant", "b"),
               (72, 1, "user", "t"), (72, 1, "assistant", "t"), (72, 1, "user", "t")]
    rejected += [(71, None, "user", "a"), (71, 1, "assistant", "c" * 50_000), (72, 1, "assistant", "t"), (72, 1, "user", "t")]
    got = pairs(spark, chosen, rejected)
    assert got == brute(chosen, rejected)
    completion, spans = got[71][4], got[71][5]
    assert completion[slice(*spans[0])] == "c" * 50_000 + preference.CLOSE


def test_swapped_endings(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "A"), (0, 2, "user", "bye"), (1, 0, "user", "yo"), (1, 1, "assistant", "B"),
            (2, 0, "user", "alone"), (2, 1, "assistant", "C"), (4, 0, "user", "mute"), (5, 0, "assistant", "D"), (None, 0, "user", "x")]
    sides = preference.swapped_endings(spark.createDataFrame([(*r, "x") for r in rows], CONV))
    got = {r.pair_id: r for r in preference.preference_pairs(*sides).collect()}
    assert set(got) == {0, 1} and got[0].n_prompt_turns == 1
    assert "\nA<" in got[0].chosen_completion and "\nB<" in got[0].rejected_completion


def test_empty(spark):
    assert pairs(spark, [], []) == {}
    none = spark.createDataFrame([], CONV)
    assert preference.preference_pairs(*preference.swapped_endings(none)).collect() == []
