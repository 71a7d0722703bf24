"""Line dedup against a direct version over all earlier documents."""

import random
from collections import defaultdict

from tablefolio.llm import line_dedup
from tablefolio.llm.common import NO_ID


def longest(places):
    """Length of a longest increasing run, the slow way."""
    best = []
    for i, p in enumerate(places):
        best.append(1 + max([best[j] for j in range(i) if places[j] < p], default=0))
    return max(best, default=0)


def lines_of(text):
    return [x.strip() for x in (text or "").split("\n") if x.strip()]


def shared_blocks(mine, other, min_words):
    """Lines of `mine` in blocks of `min_words` words that stand in `other` as they are, by extending each equal pair."""
    where, gone = defaultdict(list), set()
    for j, line in enumerate(other):
        where[line].append(j)
    for i, line in enumerate(mine):
        for j in where[line]:
            if i and j and mine[i - 1] == other[j - 1]:
                continue
            n = 0
            while i + n < len(mine) and j + n < len(other) and mine[i + n] == other[j + n]:
                n += 1
            if sum(x.count(" ") + 1 for x in mine[i:i + n]) >= min_words:
                gone.update(range(i, i + n))
    return gone


def brute(rows):
    """Texts without the lines of all blocks of ten words that stand in any earlier document; no hash, diff or partner."""
    rows = sorted(rows, key=lambda r: r[0])
    have = [lines_of(text) for _, text in rows]
    out = {}
    for k, (i, text) in enumerate(rows):
        gone = set().union(*[shared_blocks(have[k], have[e], 10) for e in range(k)])
        left, p = [], 0
        for x in (text or "").split("\n"):
            if not x.strip() or p not in gone:
                left.append(x)
            p += bool(x.strip())
        out[i] = "\n".join(left) if any(x.strip() for x in left) else ""
    return out


def test_patience():
    rng = random.Random(2)
    for _ in range(200):
        places = rng.sample(range(40), rng.randint(0, 20))
        run = line_dedup.increasing(places)
        assert run == sorted(run) and [places[i] for i in run] == sorted(places[i] for i in run)
        assert len(run) == longest(places)


def as_common(mine, other):
    """The input of `block_lines` for two lists of lines."""
    return [{"words": x.count(" ") + 1, "at": [i for i, y in enumerate(mine) if y == x],
             "there": [j for j, y in enumerate(other) if y == x]} for x in sorted(set(mine) & set(other))]


def test_patience_diff_is_an_alignment():
    assert line_dedup.patience(list("abcde"), list("xbcdy")) == [(1, 1), (2, 2), (3, 3)]
    assert line_dedup.patience(list("aba"), list("aba")) == [(0, 0), (1, 1), (2, 2)]  # the outer ones occur once beside b
    assert line_dedup.patience(list("aaxaa"), list("axaaa")) == [(0, 0), (2, 1), (3, 2), (4, 3)]
    assert line_dedup.patience([], list("ab")) == [] == line_dedup.patience(list("ab"), list("cd"))
    rng = random.Random(8)
    for _ in range(300):
        mine, theirs = (rng.choices("abcdefgh", k=rng.randint(0, 12)) for _ in range(2))
        pairs = line_dedup.patience(mine, theirs)
        assert all(mine[i] == theirs[j] for i, j in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))


def test_blocks_of_two_documents():
    rng = random.Random(5)
    pool = [" ".join(f"{w}{k}" for w in "abcdefghijkl"[:rng.randint(1, 12)]) for k in range(14)]
    for _ in range(400):
        mine, other = (rng.sample(pool, rng.randint(0, 14)) for _ in range(2))
        if rng.random() < 0.5:
            other = mine[5:] + mine[:5]  # moved
        assert set(line_dedup.block_lines(as_common(mine, other), 10)) == shared_blocks(mine, other, 10)
    block = ["one two three four", "five six seven eight", "nine ten"]
    assert line_dedup.block_lines(as_common([*block, "own", *block], ["other", *block]), 10) == [0, 1, 2, 4, 5, 6]  # repeated
    for _ in range(400):  # repeated lines: never more than stands there, and never nothing if something does
        mine, other = (rng.choices(pool, k=rng.randint(0, 20)) for _ in range(2))
        got, all_blocks = set(line_dedup.block_lines(as_common(mine, other), 10)), shared_blocks(mine, other, 10)
        assert got <= all_blocks and bool(got) == bool(all_blocks)


def test_nothing_goes_without_alignment(monkeypatch):
    block = ["one two three four", "five six seven eight", "nine ten", "a line that has ten words or more all by itself"]
    assert line_dedup.block_lines(as_common(block, block), 10) == [0, 1, 2, 3]
    monkeypatch.setattr(line_dedup, "increasing", lambda places: [])
    assert line_dedup.block_lines(as_common(block, block), 10) == []


def test_reversed_long_lists_end():
    mine = [f"short line {k}" for k in range(20_000)]
    assert line_dedup.block_lines([{"words": 3, "at": [k], "there": [20_000 - k]} for k, _ in enumerate(mine)], 10) == []


def corpus():
    rng = random.Random(6)
    pool = [" ".join(rng.choices(["red", "blue", "green", "tall", "dark", "old"], k=rng.randint(1, 14))) + f" {k}" for k in range(60)]
    passage = " ".join(f"p{k}" for k in range(55))
    made = []
    for k in range(80):
        lines = rng.sample(pool, rng.randint(0, 8)) + [f"own line {k} {j}" for j in range(rng.randint(0, 3))]
        rng.shuffle(lines)
        if k % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), passage)
        made.append(rng.choice(["\n", "\n\n", " \n "]).join(lines))
    made[10], made[11] = made[3], made[3]
    return made


def test_as_brute_force(odd):
    made = corpus()
    rows = list(enumerate(made))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(odd(made)).collect()}
    want = brute(rows)
    assert got == {i: want[i] if want[i] != "" else "" if made[i].strip() else made[i] for i in want}
    assert got[10] == got[11] == "" and sum("p0 p1" in t for t in got.values()) == 1  # a passage stays once


def test_columns_repeats_nulls_and_empty_table(odd):
    line = "a line of ten words that two documents share here"
    df = odd([None, "", line, line, "x\n" + line, "x\n" + line, line], [0, 1, None, 2, 3, 3, 5])
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "deleted_lines", "shared_with"]
    rows = sorted(((r.doc_id if r.doc_id is not None else -1), r.text, r.deleted_lines, r.shared_with) for r in out.collect()
                  if r.text is not None)
    assert rows == [(-1, line, None, None), (1, "", None, None), (2, "", [0], []), (3, "x", [1], []), (3, "x", [1], []), (5, "", [0], [])]
    assert line_dedup.dedup_lines(odd([])).collect() == []
    assert NO_ID < 0


def test_blank_is_ascii_white_space(odd):
    line = "a line of ten words that two documents share here"
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(odd([line, "\u00a0\n \t\r\nown\n" + line + "\n\u2003"])).collect()}
    assert got[1] == "\u00a0\n \t\r\nown\n\u2003"


def test_long_document(odd):
    body = "\n".join(f"line number {k} has its own words and more than ten of them" for k in range(4000))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(odd([body, "begin\n" + body + "\nend"])).collect()}
    assert got[0].text == body and got[1].text == "begin\nend" and got[1].shared_with == [0]


def test_blocks_within_one_earlier_document(odd):
    x, y, z = ("ax bx cx dx", "ay by cy dy", "az bz cz dz")
    rng = random.Random(12)
    pool = [" ".join(f"{w}{k}" for w in "abcdefgh"[:rng.randint(2, 8)]) for k in range(12)]
    made = ["\n".join([y, x]), "\n".join([x, y, z]), "\n".join([x, y, z])]
    made += ["\n".join(["p q r s", "own own one"]), "\n".join(["t u v w", "own own two"]), "\n".join(["k l m n", "own own three"]),
             "\n".join(["p q r s", "t u v w", "k l m n", "own four"])]
    made += ["\n".join(rng.sample(pool, rng.randint(1, 7))) for _ in range(120)]
    out = line_dedup.dedup_lines(odd(made)).collect()
    got = {r.doc_id: set(r.deleted_lines or []) for r in out}
    assert got[2] == {0, 1, 2}  # a copy of 1, though 0 held two of its lines first
    assert got[6] == set()  # neighbours, but of three documents
    assert {r.doc_id: r.text for r in out} == brute(enumerate(made))


def test_digest_of_many_sources_and_frequent_lines(odd):
    sources = ["\n".join(["top of each page", *[f"line {j} of source {k} with words enough to count as ten" for j in range(4)]])
               for k in range(150)]
    digest = "\n".join(x for s in sources for x in s.split("\n")[1:3])
    out = {r.doc_id: r for r in line_dedup.dedup_lines(odd([*sources, digest, *[sources[0]] * 50])).collect()}
    assert out[150].text == "" and out[150].shared_with == list(range(150))
    assert all(out[k].text == sources[k] for k in range(150)) and all(out[k].text == "" for k in range(151, 201))


def test_least_runs_cover_blocks():
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.randint(1, 12) for _ in range(rng.randint(1, 9))]
        runs = line_dedup.least_runs(words, 10)
        assert all(sum(words[a:b]) >= 10 and b - a > 1 for a, b in runs)
        for a in range(len(words)):
            for b in range(a + 1, len(words) + 1):
                if sum(words[a:b]) >= 10:
                    inside = {p for s, e in runs if a <= s and e <= b for p in range(s, e)}
                    assert set(range(a, b)) == inside | {p for p in range(a, b) if words[p] >= 10}
