"""Turn repair, hard negatives and passage removal against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from spark_revenue.llm import cover_dedup, gnat, turn_repair

from .conftest import by_id

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {2: "user", 3: "assistant"}


def cheapest(rows):
    """(cost, audit, lines) of (role, text, fault) rows, by trying every edit of every row."""

    def inserted(states):
        out = dict(states)
        for q, (cost, audit, lines) in states.items():
            for _ in range(3):
                q = NEXT[q]
                cost, audit, lines = cost + 5, audit + "I", [*lines, NAMES[q] + ":"]
                if q not in out or (cost, audit) < out[q][:2]:
                    out[q] = (cost, audit, lines)
        return out

    states = {0: (0, "", [])}
    for role, text, fault in rows:
        after = {}

        def offer(q, cost, audit, lines):
            if q not in after or (cost, audit) < after[q][:2]:
                after[q] = (cost, audit, lines)

        for q, (cost, audit, lines) in inserted(states).items():
            offer(q, cost + 2, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            late = 5 * (fault == "truncated")
            if (q, role[:1]) in KEEPS:
                offer(KEEPS[q, role[:1]], cost + late, audit + "K", [*lines, f"{role}:{text}"])
            offer(NEXT[q], cost + late + 1, audit + "R", [*lines, f"{NAMES[NEXT[q]]}:{text}"])
        states = after
    return min(v for q, v in inserted(states).items() if q in (0, 3))


SPACES = " \t\n\x0b\x0c\r"


def brute_audit(table):
    rows = []
    for conv, turn, role, text in table:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        rows += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv in {r[0] for r in table}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in own:
            bare = text.strip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[0] for r in own if r[0] is not None]
        cost, audit, lines = cheapest(marked)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[sum(f == k for *_, f in marked) for k in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def test_tables_find_the_least_edits_in_ascii_order():
    r = random.Random(2)
    for _ in range(1500):
        symbols = np.array([r.choice([0, 1, 2, 2, 2, 3, 4, 4, 4, 5, 6, 7, 8]) for _ in range(r.randint(1, 25))])
        rows = [("sua-"[s // 2], "t", "truncated" if s % 2 else None) if s < 8 else ("u", "", "blank") for s in symbols.tolist()]
        steps = turn_repair.trace(symbols)
        audit = "".join(s.edit for s in steps) + "I" * len(turn_repair.closing(steps[-1].state))
        assert audit == cheapest(rows)[1]
        cut = r.randint(0, len(symbols))
        end = int(turn_repair.vector_map(symbols[cut:])[turn_repair.END])
        first = turn_repair.trace(symbols[:cut], end)
        state = first[-1].state if first else turn_repair.NOTHING
        assert first + turn_repair.trace(symbols[cut:], state=state) == steps


@pytest.mark.parametrize("bits", [12, 2])
def test_turn_repair(spark, monkeypatch, bits):
    monkeypatch.setattr(turn_repair, "PIECE_BITS", bits)
    r = random.Random(bits)
    texts = ["Yes.", "No", "  ", "", None, "Why?", "A long\nline. \n", "é!", "x" * 300_000 + "."]
    table = []
    for conv in [*range(40), None]:
        for turn in range(r.choice([1, 3, 9, 60])):
            if r.random() < 0.9:
                table.append((conv, None if r.random() < 0.05 else turn, r.choice(["user", "assistant", "system", "usher", "tool", "", None]), r.choice(texts)))
    table += [(7, t // 3, ["user", "assistant"][t % 2], "Same.") for t in range(300)]
    table += [(99, 13, "user", "x")]
    frame = spark.createDataFrame([(*t, 1, "y") for t in table], "conv_id long, turn long, role string, text string, pos int, audit string")
    out = {x["conv_id"]: tuple(x)[1:] for x in turn_repair.audit(frame).collect()}
    assert out == brute_audit(table)
    assert turn_repair.audit(frame.limit(0)).collect() == []


def brute_negatives(rows):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    ready = []
    for k, (vec_id, vector, label) in enumerate(rows):
        if label is not None and usable(vector):
            label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
            ready.append((k, vec_id, label, [int(np.floor(256 * x)) for x in vector]))
    out = []
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for k, vec_id, label, vector in ready:
        if vec_id is None or vec_id % 100:
            continue
        scored = [(sum(a * b for a, b in zip(vector, v)), i, lab) for j, i, lab, v in ready if j != k]
        for ps, pid, _ in sorted((s for s in scored if s[2] == label), key=key)[:5]:
            fits = [s for s in scored if s[2] != label and 80 * ps <= 100 * s[0] <= 100 * ps]
            out += [(vec_id, pid, n, nid, ps, ns) for n, (ns, nid, _) in enumerate(sorted(fits, key=key)[:5], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hard_negatives(spark, monkeypatch, seed):
    monkeypatch.setattr(gnat, "LEAF_ROWS", [4, 40, 1024][seed - 1])
    monkeypatch.setattr(gnat, "SHARD_ROWS", [(16, 16), (64, 64), (256, 16_384)][seed - 1])
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 6))
    rows = []
    for i in range(900):
        v = centres[rng.integers(12)] * rng.uniform(0.3, 1.5) + rng.normal(size=6) * 0.2
        rows.append((i, np.float32(v).tolist(), int(rng.integers(4))))
    rows += [(1000 + i, rows[100][1], int(rng.integers(3))) for i in range(200)]
    rows += [rows[100], rows[100], rows[200], (None, rows[300][1], 2), (None, rows[200][1], 1), (1300, [1.0, 2.0], 1), (1400, [], 1)]
    rows += [(1500, None, 1), (1600, [1.0] * 6, None), (1700, [1.0, None] * 3, 1), (1800, [float("nan")] * 6, 1), (1900, [float("inf")] * 6, 2), (2000, [0.0] * 6, 1)]
    frame = spark.createDataFrame([(*r, 0, 1) for r in rows], "vec_id long, embedding array<float>, label int, rid int, leaf int")
    out = gnat.mine(frame)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, out.collect()), key=str) == brute_negatives(rows)
    assert gnat.mine(frame.limit(0)).collect() == []
    assert gnat.mine(frame.filter("vec_id = 101")).collect() == []


def test_ranges_rule_out_siblings_and_lose_nothing():
    rng = np.random.default_rng(4)
    rows = np.floor(256 * (rng.normal(size=(10, 8))[rng.integers(10, size=3000)] + rng.normal(size=(3000, 8)) * 0.05))
    radius = float(np.sqrt((rows * rows).sum(axis=1).max()))
    tree = gnat.fit(rows[:500], radius, 2)
    tree.ranges = {k: np.tile([np.inf, -np.inf], (len(p), len(p), 1)) for k, p in tree.points.items()}
    lifted = gnat.lifted(rows, radius)
    for node, _, child, far in gnat._descend(tree, lifted):
        for j in np.unique(child):
            tree.ranges[node][:, j, 0], tree.ranges[node][:, j, 1] = far[child == j].min(axis=0), far[child == j].max(axis=0)
    leaf, scores = gnat.leaf_of(tree, lifted), rows[:50] @ rows.T
    high = np.sort(scores, axis=1)[:, -2][:, None]
    alive = gnat.survivors(tree, rows[:50], 0.8 * high, high)
    fits = (scores >= 0.8 * high) & (scores <= high)
    assert all(alive[a, leaf[fits[a]]].all() for a in range(50))
    assert alive.mean() < 0.5


def brute_passages(rows, width=20):
    order = sorted({(k is not None, k or 0, (t or "")) for k, t in rows})
    words = {x: [w for w in x[2].translate({ord(c): " " for c in SPACES}).split(" ") if w] for x in order}
    seen, out = {}, {}
    for x in order:
        gone = [False] * len(words[x])
        for i in range(len(words[x]) - width + 1):
            window = tuple(words[x][i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen[window] = True
        kept = " ".join(w for w, g in zip(words[x], gone) if not g)
        out[x] = (len(words[x]), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_cover_brings_any_two_places_together():
    for d in range(cover_dedup.PERIOD):
        assert any((a + d) % cover_dedup.PERIOD in cover_dedup.COVER for a in cover_dedup.COVER)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages(documents, seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "Été", "x1", "long" * 9]) if seed == 1 else f"w{r.randint(0, 400)}"
    line = lambda n: [word() for _ in range(n)]
    shared = [line(n) for n in (19, 20, 21, 33, 70)]
    texts = []
    for _ in range(120):
        parts = [line(r.randint(0, 40)) for _ in range(r.randint(0, 3))] + [r.choice(shared) for _ in range(r.randint(0, 2))]
        r.shuffle(parts)
        texts.append(r.choice([" ", "\n", " \t "]).join(w for p in parts for w in p))
    texts += [None, "", "  ", " ".join(["same"] * 100), " ".join(shared[3] * 2), texts[5], texts[5] + " "]
    texts += [" ".join(line(40)) + "  nbsp em " + " ".join(shared[4]), " ".join(f"v{i % 9000}" for i in range(300_000))]
    rows = list(enumerate(texts)) + [(None, texts[3]), (None, " ".join(shared[4])), (2, texts[9]), (4, texts[4]), (4, texts[4])]
    r.shuffle(rows)
    frame = documents(rows)
    want = brute_passages([(k, t) for k, t in rows])
    out = sorted((tuple(x) for x in cover_dedup.remove_repeats(frame).collect()), key=str)
    assert len(out) == len(rows)
    # Rows that share an id follow a hash; those are compared as a set in which either may come first.
    plain = {k for k, _ in rows if k is not None and k not in (2, 4)}
    assert [x for x in out if x[0] in plain] == sorted(((k, *want[True, k, t or ""]) for k, t in rows if k in plain), key=str)
    assert cover_dedup.remove_repeats(documents([])).collect() == []


def test_first_of_many_copies_stays(documents):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text) for i in range(3, 300)] + [(300 + i, f"x{i} " + text) for i in range(300)] + [(2, "y " + text + " z")]
    out = by_id(cover_dedup.remove_repeats(documents(rows)))
    assert [k for k, v in out.items() if v["n_removed"] == 0] == [2]
    assert all(v["n_removed"] == 60 for k, v in out.items() if k != 2)
