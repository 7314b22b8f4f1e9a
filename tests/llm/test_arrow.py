"""Suffix dedup, token grammar, importance, templates, near duplicates and the pipeline on small cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spark_revenue.llm import grammar_store, importance, odd_sketch, suffix_dedup, templates
from spark_revenue.llm.queries import tokenizer_path

from .conftest import by_id


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_deep_shallow_orders_like_sorting():
    r = random.Random(3)
    for _ in range(300):
        head = bytes(r.choice(b"ab") for _ in range(r.randint(0, 25)))
        strings = [head + bytes(r.choice(b"abc") for _ in range(r.randint(0, 5))) + b"z" * r.randint(0, 20) for _ in range(r.randint(1, 25))]
        for shallow in (0, 2, 16):
            order, lcp = suffix_dedup.deep_shallow(strings, 0, shallow)
            assert [strings[i] for i in order] == sorted(strings) and len(lcp) == len(strings)


def brute_removal(texts, length=200):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone[:-1], strict=True) if not g)
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [4096, 1])
def test_suffix_dedup(documents, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", most)
    base = prose(1, 120)
    texts = [base, base, prose(2, 30) + base[50:400] + prose(3, 40), base[:300] + "!" + base[300:], "x" * 450, "y" * 200, "y" * 201, "short", None, ""]
    texts += [prose(4, 20) + base[100:330] + prose(5, 9), prose(6, 30) + base[100:290]]
    out = by_id(suffix_dedup.remove_repeats(documents(list(enumerate(texts)))))
    for i, want in enumerate(brute_removal([(t or "").encode() for t in texts])):
        assert (out[i]["n_bytes"], out[i]["n_removed"], out[i]["n_spans"], out[i]["kept_sha256"]) == want, i
    assert suffix_dedup.remove_repeats(documents([])).count() == 0


def test_periodic_runs_across_a_part_of_a_long_text(documents, monkeypatch):
    """Equal strings over the place where a long text is parted keep one anchor, ties included."""
    monkeypatch.setattr(suffix_dedup, "_PLACES", 2048)
    r = random.Random(8)
    for size in (260, 330, 420):
        run = "".join(r.choice("abc") for _ in range(7)) * 80
        noise = lambda n: "".join(r.choice("defghijklmnop") for _ in range(n))
        texts = [noise(1848 * k - size // 2) + run[:size] + noise(1500) for k in (1, 2, 3)] + [noise(40) + run[:size] + noise(9), noise(6000)]
        out = by_id(suffix_dedup.remove_repeats(documents(list(enumerate(texts)))))
        for i, want in enumerate(brute_removal([t.encode() for t in texts])):
            assert (out[i]["n_bytes"], out[i]["n_removed"], out[i]["n_spans"], out[i]["kept_sha256"]) == want, (size, i)


def test_text_beyond_the_parts(documents):
    """A row of 5 MB with a periodic run over byte 4,194,304 and the same run in a short row."""
    r = random.Random(9)
    noise = lambda n: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    run = "0123456" * 60
    texts = [noise(4_194_304 - 200) + run + noise(800_000), noise(50) + run + noise(50)]
    out = by_id(suffix_dedup.remove_repeats(documents(list(enumerate(texts)))))
    assert all(out[i]["n_removed"] == len(run) and out[i]["n_spans"] == 1 for i in (0, 1))
    assert out[0]["kept_sha256"] == hashlib.sha256(texts[0].replace(run, "").encode()).hexdigest()


def test_many_contexts_agree_with_few(monkeypatch):
    r = random.Random(5)
    for _ in range(100):
        made = {(bytes(r.choice(b"ab") for _ in range(n)) + b"ANCHOR" + bytes(r.choice(b"ab") for _ in range(r.randint(max(0, 6 - n), 6))), n) for n in [r.randint(0, 6) for _ in range(9)]}
        contexts = [(t, at, r.choice([1, 1, 2])) for t, at in sorted(made)]
        flat = lambda parts: [{k for x, y in p for k in range(x, y)} for p in parts]
        few = flat(suffix_dedup.repeated(contexts, 12))
        monkeypatch.setattr(suffix_dedup, "FEW", 1)
        assert flat(suffix_dedup.repeated(contexts, 12)) == few
        monkeypatch.setattr(suffix_dedup, "FEW", 24)


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 30, 5000), np.full(999, 7), np.zeros(0, int), np.array([5])):
        cuts = np.unique(np.concatenate([[0], rng.integers(0, len(ids) + 1, 20), [len(ids)]]))
        g = grammar_store.from_bytes(grammar_store.to_bytes(grammar_store.compress(ids, cuts, 100)))
        assert (grammar_store.expand(g, g.symbols) == ids).all()
        for k in range(len(cuts) - 1):
            assert (grammar_store.document_ids(g, k) == ids[cuts[k] : cuts[k + 1]]).all()
    g = grammar_store.compress(np.tile([1, 2, 3], 2000), np.array([0, 6000]), 10)
    assert len(g.symbols) < 1000 and (g.lengths >= 2).all()


def test_token_grammar(documents):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    texts = ["Hello, World!! don't 12.5kg", None, "", "a <|endoftext|> b<|ENDOFTEXT|>", "İÉ é 東京 \x0b", prose(9, 4000)]
    rows = [*enumerate(texts), (None, "no id"), (3, "again"), (3, "again")]
    out = sorted(grammar_store.tokenise(documents(rows), tokenizer_path()).collect(), key=lambda r: r["start"])
    assert len(out) == len(rows) and out[0]["doc_id"] is None
    assert [r["doc_id"] for r in out[1:]] == sorted(x[0] for x in rows if x[0] is not None)
    at = 0
    for r in out:
        assert r["start"] == at
        at += r["n_tokens"]
    want = Counter()
    for ident, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        want[ident, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == want
    assert grammar_store.tokenise(documents([]), tokenizer_path()).count() == 0


def test_importance(spark, documents):
    good = [(i, prose(i, 3) + " the of and to in that was " * 8) for i in range(120)]
    bad = [(1000 + i, "buy $$$ now | " * 15 + prose(i, 2)) for i in range(40)]
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in (good + bad)[::2]] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents([*good, *bad, (None, None), (5, "")])
    out = importance.resample(docs, labels, share=0.75).collect()
    assert len(out) == 162 and sum(r["kept"] for r in out) == round(162 * 0.75)
    assert sum(r["kept"] for r in out if r["doc_id"] and r["doc_id"] >= 1000) <= 2
    again = {(r["doc_id"], r["noisy"]): r["kept"] for r in importance.resample(docs, labels, share=0.75).collect()}
    assert again == {(r["doc_id"], r["noisy"]): r["kept"] for r in out}
    assert importance.resample(documents([]), labels).count() == 0
    assert all(r["kept"] for r in importance.resample(docs, labels.limit(0)).collect())


def test_templates(spark, documents):
    item = "A farmer named Alice buys 12 apples and 12 pears for 30 dollars at the market while the old clerk counts them"
    other = item.replace("Alice", "Maria").replace("12", "45").replace("30", "7")
    clash = item.replace("12 pears", "13 pears")
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id long, text string")
    texts = [f"Before. {item} after", prose(1, 40) + ". " + other, prose(2, 40) + ". " + clash, prose(3, 60), None, "", item[:40]]
    out = by_id(templates.decontaminate(documents([*enumerate(texts), (0, texts[0])]), bench))
    assert [out[i]["contaminated"] for i in range(7)] == [True, True, False, False, False, False, False]
    assert not out[0]["changed"] and out[1]["changed"] and out[1]["items"] == [1]
    assert templates.decontaminate(documents([]), bench).count() == 0
    assert not any(r["contaminated"] for r in templates.decontaminate(documents([(1, item)]), bench.limit(0)).collect())


def test_templates_judge_runs(spark, documents):
    head = "A farmer named Alice buys 12 apples and 30 pears at the market while the old clerk counts them"
    tail = " ".join(prose(40, 40).split()) + " and 12 plums"
    bench = spark.createDataFrame([(1, head), (2, f"{head} {tail}")], "item_id long, text string")
    merged = prose(41, 30) + ". " + head.replace("12", "20").replace("30", "20")
    edited = prose(42, 30) + f". {head} {tail[:-9]} 13 plums"
    swapped = prose(43, 30) + ". " + f"{head} {tail}".replace("buys 12", "buys 13")
    out = by_id(templates.decontaminate(documents([(0, merged), (1, edited), (2, swapped)]), bench))
    assert [out[i]["items"] for i in range(3)] == [[1, 2]] * 3
    assert out[0]["changed"] and out[1]["n_windows"] > 40


ITEM = (
    "Tom has 3.5 liters of milk. Tom gives 1,250 marbles to Ann Lee. Tom keeps 5kg of dry rice. "
    "Tom then walks 7 miles home with his dog."
)


@pytest.mark.parametrize("text", [
    ITEM,
    ITEM.lower(),
    ITEM.upper(),
    ITEM.replace("Tom", "Eva"),
    ITEM.replace("Tom", "Mary Ann Smith").replace("Ann Lee", "Bob"),
    ITEM.replace("3.5", "4").replace("1,250", "980").replace("5kg", "12.5 kg").replace("7 miles", "2 miles"),
])
def test_templates_read_names_and_values(spark, documents, text):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = [(0, f"{prose(50, 20)}. {text} {prose(51, 20)}"), (1, f"{prose(50, 20)} {prose(51, 60)}")]
    out = by_id(templates.decontaminate(documents(rows), bench))
    assert out[0]["items"] == [1] and not out[1]["contaminated"]
    assert out[0]["changed"] == (text.lower() != ITEM.lower())


def test_readings():
    def kinds(*texts):
        rows = [t.encode() for t in texts]
        starts = np.cumsum([0, *map(len, rows)])
        marks = {int(templates.NUMBER): "#", int(templates.NAME): "N", int(templates.UNIT): "u"}
        read = templates.readings(np.frombuffer(b"".join(rows), np.uint8), starts)
        return [["".join(marks.get(int(t), "w") for t in r.template[a:b]) for a, b in zip(r.rows, r.rows[1:])] for r in read]

    assert kinds("1,250 and 3.5kg, 5 kg", "", "7", "x86 3rd 5kgs a1b2") == [["#w#u#u", "", "#", "wwww"]] * 3
    assert kinds("Mary Ann Lee met O'Neil, Bob. Then Al-Amin Ö went") == [["w" * 12], ["wNwNNwNw"], ["NwNNNw"]]
    assert kinds("", " .", "") == [["", "", ""]] * 3


def test_templates_find_short_items(spark, documents):
    items = [
        "Paris", "What is 2 + 2?", "Name the largest of these: 3, 7, 9", "Which planet near the sun has 2 small moons today",
        "Compute the sum " + " + ".join(str(k) for k in range(40)) + " quickly", "Kepler found that each planet moves in an ellipse about our sun",
        "?!", "", None,
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"so {t[0].lower()}{t[1:]} {prose(i, 20)}" for i, t in enumerate(items[:6])]
    texts += [items[3].replace("2", "5"), "what is 2 + 3", "what was 2 + 2", items[4].replace("39", "38"), items[5][:-4], "in " + items[5], ""]
    out = by_id(templates.decontaminate(documents(list(enumerate(texts))), bench))
    assert [out[i]["items"] for i in range(13)] == [[0], [1], [2], [3], [4], [5], [3], [], [], [], [], [5], []]
    assert out[6]["changed"] and not out[3]["changed"]


def test_whole_runs():
    r = random.Random(6)
    rows = [[r.choice(["a", "b", "7"]) for _ in range(n)] for n in (0, 1, 5, 9, 0, 30)]
    texts = [" ".join(x).encode() for x in rows]
    literal, first = templates.words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    for width in (1, 2, 4, 8):
        hashes, begin, row = templates.wholes(literal, first, width)
        told = [tuple(rows[i][b - first[i] :][:width]) for b, i in zip(begin, row)]
        assert told == [tuple(x[k : k + width]) for x in rows for k in range(len(x) - width + 1)]
        assert len(set(zip(told, hashes.tolist()))) == len(set(told)) == len(set(hashes.tolist()))


def test_stretches_agree_with_brute_force():
    r = random.Random(5)
    for _ in range(300):
        at = sorted(r.sample(range(14), r.randint(1, 12)))
        xs = [[r.randint(0, 3) for _ in range(r.randint(0, 2))] for _ in at]
        ys = [[v if r.random() < 0.8 else r.randint(0, 3) for v in x] for x in xs]

        def agree(a, b):
            pairs = {p for x, y in zip(xs[a:b], ys[a:b]) for p in zip(x, y)}
            return len({x for x, _ in pairs}) == len(pairs), any(x != y for x, y in pairs)

        runs = [(a, b) for a in range(len(at)) for b in range(a + 1, len(at) + 1) if at[b - 1] - at[a] == b - 1 - a and agree(a, b)[0]]
        told = (agree(0, len(at))[0], max((b - a for a, b in runs), default=0), any(b - a >= 3 and agree(a, b)[1] for a, b in runs))
        assert templates._stretches(at, xs, ys, 3) == told


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
                comp = [new if c == old else c for c in comp]
    return sets, comp


def test_near_duplicates(documents):
    r = random.Random(4)
    rows = []
    for g in range(8):
        base = prose(100 + g, 120).split()
        for _ in range(12):
            w = list(base)
            for _ in range(r.randint(0, 9)):
                w[r.randrange(len(w))] = prose(r.random(), 1)
            rows.append(" ".join(w))
    rows += ["one two", "One  Two", "one two three", None, "", rows[0], rows[0].upper(), prose(77, 9000)]
    rows = list(enumerate(rows))
    r.shuffle(rows)
    rows.sort(key=lambda x: x[0])
    sets, comp = brute_components(rows)
    out = by_id(odd_sketch.near_duplicates(documents(rows)))
    for i, _ in rows:
        assert out[i]["n_shingles"] == len(sets[i]) and out[i]["component_id"] == comp[i] and out[i]["kept"] == (comp[i] == i)
    once = odd_sketch.deduplicate(documents([*rows, rows[0], (None, rows[0][1]), (None, ""), (None, prose(78, 30))]))
    ids = [x["doc_id"] for x in once.collect()]
    assert sorted(x for x in ids if x is not None) == sorted({c for c in comp}) and ids.count(None) == 2
    assert odd_sketch.near_duplicates(documents([])).count() == 0


def test_near_duplicates_need_few_stages(spark, documents):
    """Chains, stars and copies: the rounds over components are few, whatever the paths between the links are."""
    words = prose(55, 400).split()
    chain = [" ".join(words[4 * i : 4 * i + 60]) for i in range(80)]
    star = [" ".join([*words[:100], *prose(2000 + i, 6).split()]) for i in range(40)]
    rows = list(enumerate([*chain, *star, *[star[0].upper()] * 40]))
    _, comp = brute_components(rows)
    spark.sparkContext.setJobGroup("near-few", "near duplicates")
    try:
        out = by_id(odd_sketch.near_duplicates(documents(rows)))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [out[i]["component_id"] for i, _ in rows] == comp and len(set(comp)) < 60
    tracker = spark.sparkContext.statusTracker()
    jobs = tracker.getJobIdsForGroup("near-few")
    ran = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
    n = len({s.stageId for s in ran if s is not None and s.numCompletedTasks})
    assert n < 160, (n, len(jobs))


def test_sketch_distance_follows_similarity():
    r = np.random.default_rng(2)
    for share in (0.75, 0.9):
        common = r.integers(0, 1 << 62, int(2000 * share), dtype=np.uint64)
        a, b = (np.concatenate([common, r.integers(0, 1 << 62, (2000 - len(common)) // 2, dtype=np.uint64)]) for _ in range(2))
        x, y = (odd_sketch._sketches(odd_sketch._minima(v)[None])[0] for v in (a, b))
        assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= odd_sketch.MOST_BITS


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    item = " ".join(prose(500, 30).split())
    docs = [(i, prose(i, 60), "en", f"s{i % 2}") for i in range(40)]
    docs += [(100, docs[0][1] + " end", "en", "s0"), (101, prose(900, 30) + " " + item + " " + prose(901, 30), "en", "s1"), (102, "bad", "en", "s0"), (103, None, "en", None)]
    spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, frame = frame.columns, stage(spark, frame, str(tmp_path))
        assert frame.columns == before
    assert sorted(r["doc_id"] for r in frame.collect()) == list(range(40))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= set(range(40)) and len(out) >= 40
    assert max(r["start"] + r["n_tokens"] for r in out) == sum(r["n_tokens"] for r in out)


def test_importance_equals_a_plain_model(spark, documents):
    """Scores from models kept in dictionaries, noise from the scores alone, and the k largest sums."""
    r = random.Random(12)
    rows = [(i, " ".join(r.choice(["the", "of", "cat", "a1", "é", "$", "buy!", "x,y"]) for _ in range(r.randint(0, 30)))) for i in range(250)]
    rows += [(3, rows[3][1]), (4, "again the cat"), (None, "of the"), (9, None)]
    good = {i for i in range(0, 250, 3)}
    labels = spark.createDataFrame([(i, int(i in good), 0) for i in range(0, 250, 2)] + [(3, 1, 0)], "doc_id long, quality int, toxic int")
    good = {i for i in good if i % 2 == 0 or i == 3}

    def grams(text):
        w = re.findall(r"[0-9A-Za-z_\x80-\U0010ffff]+|[^0-9A-Za-z_\x80-\U0010ffff\x20\x09-\x0D]+", text or "")
        return [tuple(w[k : k + n]) for n in (1, 2) for k in range(len(w) - n + 1)]

    def bucket(gram):
        data = " ".join(gram).encode()
        found, _ = importance.buckets(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        return int(found[-1])

    place = {g: bucket(g) for _, t in rows for g in grams(t)}

    def model(texts):
        n = Counter(place[g] for t in texts for g in grams(t))
        total = sum(n.values()) + 65536
        return lambda b: math.log((n[b] + 1) / total)

    target, raw = model([t for i, t in rows if i in good]), model([t for _, t in rows])
    want = Counter((i, round(sum(target(place[g]) - raw(place[g]) for g in grams(t)), 6)) for i, t in rows)
    out = importance.resample(documents(rows), labels, share=0.4).collect()
    assert Counter((x["doc_id"], round(x["score"], 6)) for x in out) == want
    line = sorted((x["noisy"] for x in out), reverse=True)
    k = round(0.4 * len(rows))
    assert sum(x["kept"] for x in out) == k
    assert all(x["noisy"] >= line[k - 1] for x in out if x["kept"]) and all(x["noisy"] <= line[k - 1] for x in out if not x["kept"])
