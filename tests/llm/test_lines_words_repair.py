"""Shared lines, spelling groups and conversation repair against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from colloquy.llm import linededup, repair, spelling

DOCS = "doc_id long, text string, lang string, _row string, _drop string, n long, k1 string, word string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "y", 0, "z", "w") for i, t in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ 13
def plain_lines(rows):
    key = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in rows:
        for s in (t or "").split("\n"):
            if len(key(s)) >= 40 and i is not None:
                holders[key(s)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [s for s in lines if not (len(holders.get(key(s), ())) >= 5 and i != max(holders[key(s)]))]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(1)
    shared = [f"This Line Number {k} is printed at the foot of many pages É" for k in range(6)]
    rows = []
    for i in range(400):
        lines = [f"own line {i} {k} " + "filler " * rng.randrange(8) for k in range(rng.randrange(4))]
        lines += [rng.choice(["", " ", "\t"]) + (s.upper() if rng.random() < .3 else s) + rng.choice(["", "\r", " \x0b"])
                  for s in shared if rng.random() < .3]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    four = "found in four documents only, which is below the limit"
    rows += [(500 + k, four) for k in range(4)] + [(600, four[:39])] * 2 + [(601 + k, four[:39]) for k in range(6)]
    hot = "the footer that a third of all documents show at the very end"
    rows = [(i, (t + "\n" + hot) if i % 3 == 0 else t) for i, t in rows]
    last = shared[0] + "\nown\n" + shared[0]  # both stay in the largest id
    return rows + [(900, last), (900, last), (900, shared[1] + "\nother text"), (None, shared[0] + "\nnameless"), (None, None), (901, None),
                   (902, ""), (903, "\n\n"), (904, "x\n" * 30_000 + shared[2])]


def test_shared_lines_go(spark, line_rows):
    got = linededup.op13_query(frame(spark, line_rows).repartition(5)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_lines(line_rows)))
    out = linededup.drop_shared_lines(frame(spark, line_rows))
    assert out.columns == frame(spark, []).columns and out.count() == len(line_rows)
    assert {r["_row"] for r in out.collect()} == {"x"} and out.where("doc_id = 901 and text is null").count() == 1


def test_shared_lines_of_an_empty_table(spark):
    assert linededup.op13_query(frame(spark, [])).collect() == []


# ------------------------------------------------------------------ 11
def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_groups(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def variants(rng, word):
    at, c = rng.randrange(len(word) + 1), rng.choice("abcdeéÿ×")
    return rng.choice([word[:at] + c + word[at:], word[:at] + word[at + 1:], word[:at] + c + word[at + 1:]])


@pytest.fixture(scope="module")
def word_rows():
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdeÉ") for _ in range(rng.randrange(7, 13))) for _ in range(50)] + ["aaaaaaa", "aaaaaaaa", "bananabanana"]
    words = base * 40
    for w in base:
        for _ in range(8):
            v = variants(rng, w)
            words += [v] * rng.choice([1, 2, 3, 30]) + [variants(rng, v)] * 2
    words += [w.upper() for w in base] + ["x" * 30_000] * 3 + ["x" * 29_999] * 40 + ["short"] * 50
    rng.shuffle(words)
    rows = [(k, " ".join(words[k * 20:(k + 1) * 20]).replace(" a", "-a")) for k in range(len(words) // 20 + 1)]
    return rows + [(None, words[0] + " " + words[1]), (3, words[2]), (3, words[2]), (4000, None), (4001, ""), (4002, "12 !? 中文")]


def test_spelling_groups(spark, word_rows):
    got = [tuple(r) for r in spelling.op11_query(frame(spark, word_rows).repartition(3)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_groups(word_rows)


def test_spelling_groups_over_many_blocks(spark, word_rows, monkeypatch):
    """Groups larger than a block meet block by block."""
    monkeypatch.setattr(spelling, "BLOCK", 2)
    assert {tuple(r) for r in spelling.op11_query(frame(spark, word_rows)).collect()} == plain_groups(word_rows)


def test_spelling_groups_of_an_empty_table(spark):
    assert spelling.op11_query(frame(spark, [])).collect() == []


def test_bit_slices_equal_pairwise_edits():
    """Every pair is found once over all groups its words share."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(7, 10))) for _ in range(150)})
    groups = defaultdict(list)
    for w in words:
        for longer in (len(w), len(w) + 1):
            a = (longer - 1) // 2
            groups[longer, 0, w[:a]].append(w)
            groups[longer, 1, w[len(w) - (longer - a):]].append(w)
    found = Counter()
    for (longer, side, _), members in groups.items():
        index = spelling.BitSlices(members, [1] * len(members))
        for w in members:
            hits = index.near(w, longer, side)
            found.update((w, index.words[k]) for k in range(len(members)) if hits >> k & 1)
    assert found == Counter((a, b) for a in words for b in words if one_edit(a, b))


# ------------------------------------------------------------------ 12
def plain_repair(rows):
    convs = {}
    for conv, turn, role, text in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if d == 4 else role, "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(d, 1)
    return [(conv, *repaired(rows)) for conv, rows in convs.items()]


def repaired(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    faults, seen = [], set()
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not core else "d" if (role, text) in seen else "" if core[-1] in ".!?" else "t")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    ways = {"": (0, "", ())}

    def insert(ways):
        for _ in range(2):
            for q, (c, a, o) in list(ways.items()):
                for r, full in (("u", "user:"), ("a", "assistant:")):
                    if (q, r) in step:
                        new = (c + 3, a + "I", (*o, full))
                        ways[step[q, r]] = min(ways.get(step[q, r], new), new)
        return ways

    for (_, role, text), f in zip(rows, faults):
        after = {}
        for q, (c, a, o) in insert(dict(ways)).items():
            options = [(q, c + 4, "D", o)]
            if f not in ("b", "d"):
                late = 3 * (f == "t")
                options += [(step.get((q, role[:1])), c + late, "K", (*o, f"{role}:{text}"))]
                options += [(step.get((q, r[0])), c + 3 + late, "R", (*o, f"{r}:{text}")) for r in ("user", "assistant")]
            for p, cost, letter, lines in options:
                if p is not None:
                    after[p] = min(after.get(p, (cost, a + letter, lines)), (cost, a + letter, lines))
        ways = after
    cost, audit, lines = min(v for q, v in insert(ways).items() if q in ("", "a"))
    turns = {t for t, _, _ in rows if t is not None}
    kinds = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:])), cost, audit, sha("\n".join(lines)))


CONV = "conv_id long, turn long, role string, text string, mark string, first string, _pid int"


def chats(spark, rows):
    return spark.createDataFrame([(*r, "m", "f", 1) for r in rows], CONV)


def random_chat(rng, conv, turns):
    said = ["Fine.", "no end", "", " \t", "Yes!", "What?\r\n", "\x0b", "a.b", "Fine."]
    return [(conv, t, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "usurper", "User"]),
             rng.choice([*said, f"text {rng.randrange(1000)}.", None])) for t in turns]


def test_repair_equals_a_plain_version(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(300):
        turns = rng.sample(range(-3, 40), rng.randrange(1, 12))
        rows += random_chat(rng, conv, sorted(turns) + ([None] if rng.random() < .2 else []))
    rows += [(conv, t, ("user", "assistant")[t % 2], f"Turn {t} of {conv}.") for conv in range(300, 360) for t in range(rng.randrange(1, 9))]
    rows += [r for r in rows[:40]]  # repeated rows
    rows += random_chat(rng, None, range(6)) + [(400, 0, "user", "word " * 100_000 + ".")]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    got = {tuple(r) for r in repair.op12_query(chats(spark, rows).repartition(3)).collect()}
    assert got == set(plain_repair(rows))
    assert next(r for r in got if r[0] == dropped)[1:] == (0, 0, 0, 0, 0, 0, "", sha(""))


def test_repair_of_conversations_over_many_partitions(spark, monkeypatch):
    """A hot conversation is worked out in parts that meet in the right state."""
    rng = random.Random(9)
    rows = []
    for conv, n in ((0, 3), (1, 900), (2, 2), (3, 1500), (4, 700), (5, 1)):
        for t in range(n):
            role = rng.choice(["user", "assistant"]) if rng.random() < .4 else ("user", "assistant")[t % 2]
            rows.append((conv, t // 2 * 2 if conv == 4 and t % 5 else t, role, f"said {rng.randrange(400)}" + rng.choice([".", ".", ""])))
    unique = {}
    for r in rows:  # rows of one turn need no order of their own here
        unique.setdefault(r[:2], r)
    rows = list(unique.values()) + [(6, None, "user", f"{k}.") for k in range(1)]
    monkeypatch.setattr(repair, "BLOCK", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = {r.conv_id: tuple(r) for r in repair.op12_query(chats(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {r[0]: r for r in plain_repair(rows)}
    assert got.keys() == want.keys() and all(got[c] == want[c] for c in want)


def test_repair_of_an_empty_table(spark):
    assert repair.op12_query(chats(spark, [])).collect() == []


def test_grammar_gives_back_its_sequences():
    rng = random.Random(3)
    texts = ["".join(rng.choices("suaxU", [1, 8, 8, 1, 1], k=rng.randrange(1, 60))) for _ in range(200)] + ["uuuuuuuuu", "u"]
    terminals, rules, packed = repair.re_pair(texts)
    words = list(terminals)
    for a, b in rules:
        words.append(words[a] + words[b])
    assert ["".join(words[k] for k in p) for p in packed] == texts and rules
    assert sum(map(len, packed)) < sum(map(len, texts)) / 2
