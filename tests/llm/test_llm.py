"""Edge cases of the problems on texts, against brute force, exact sums or held-out accuracy."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trajlake.functions.text import words
from trajlake.llm import copies, subjects
from trajlake.llm.copies import collapse_copies
from trajlake.llm.leaks import Pieces, find_leaks, myers
from trajlake.llm.mix import TOKENIZER, load_tokenizer, mix_sources
from trajlake.llm.subjects import Model, Settings, fit_subjects, score_subjects, sentences

RECORDS = "grp string, id bigint, text string, doc string, form string, digest string"


def collapse(df):
    return collapse_copies(df, F.col("id"), [F.col("grp")], F.col("text"), F.col("doc"), F.col("grp"))


def test_copies_match_brute_force(spark):
    rng = random.Random(0)
    rows = []
    for i in range(1500):
        w = rng.choice([["pick", "it"], ["pick", "up"], ["Straße", "7"], ["move", "número", "4"], []] + [["t", str(n)] for n in range(400)])
        d = {"a": rng.choice([1, 2.0]), "b": {"c": rng.choice([None, True]), "d": [1, 2]}}
        items = list(d.items())
        rng.shuffle(items)
        text = rng.choice([" ", "-", "　"]).join(rng.choice([str.lower, str.upper, str.title])(x) for x in w) + rng.choice(["", ".", " \n"])
        rows.append((rng.choice(["g", "h", None]), i, rng.choice([text, text, None if not w else text]), json.dumps(dict(items), indent=rng.choice([None, 2])), "clash", "clash"))
    rows += rows[:100]  # delivered again
    rows += [("g", 5000, "same", '{"broken": ', "", ""), ("g", 5001, "SAME", '{"broken": ', "", ""), ("g", 5002, "same", None, "", ""), ("g", 5003, "Same!", None, "", ""), ("g", None, "same", None, "", "")]

    def key(r):
        try:
            doc = json.dumps(json.loads(r[3]), sort_keys=True).replace("2.0", "2") if r[3] is not None else None
        except ValueError:
            doc = r[3].strip()
        w = words(r[2])
        return (r[0], tuple(w), doc) if w else ("none", r[1])

    groups: dict = {}
    for r in rows:
        if r[1] is not None:
            groups.setdefault(key(r), set()).add(r[1])
    want = {(i, min(g), len(g)) for g in groups.values() for i in g}
    got = [(r["record_id"], r["keep_id"], r["copies"]) for r in collapse(spark.createDataFrame(rows, RECORDS).repartition(7)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert collapse(spark.createDataFrame([], RECORDS)).count() == 0


def test_merged_filters_never_lose_a_repeat():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    h = rng.integers(-(2**63), 2**63 - 1, 4000)
    parts = np.array_split(np.concatenate([h, h[:300]]), 9)
    bits, rows = 1 << 18, []
    for p in parts:
        for b in copies._filters(bits, bits)(iter([pa.RecordBatch.from_arrays([pa.array(p)], ["h"])])):
            rows += list(zip(*(c.to_pylist() for c in b.columns)))
    rows.sort(key=lambda r: r[0])
    batch = pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*rows)], ["segment", "once", "again"])
    whole = np.zeros(bits // 8, np.uint8)
    for out in copies._merge(iter([batch])):
        for seg, again in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            whole[seg * copies.SEGMENT // 8 : (seg + 1) * copies.SEGMENT // 8] = np.frombuffer(again, np.uint8)
    bit = np.unpackbits(whole)
    a, b = copies.probes(h, bits, bits)
    maybe = (bit[a] & bit[b]).astype(bool)
    assert maybe[:300].all() and maybe[300:].mean() < 0.05


def test_filters_in_slices_give_the_same_copies(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(None, i, f"word {rng.randint(0, 30_000)}", None, "", "") for i in range(20_000)]
    df = spark.createDataFrame(rows, RECORDS)
    whole = sorted(map(tuple, collapse(df).collect()), key=lambda r: r[1])
    monkeypatch.setattr(copies, "SLICE", 1 << 17)  # four slices instead of one
    assert sorted(map(tuple, collapse(df).collect()), key=lambda r: r[1]) == whole
    assert copies.probes(np.arange(1000) * 7**18, 1 << 19, 1 << 17)[0].max() >= 1 << 17
    one, two = copies.probes(np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 1000), 1 << 19, 1 << 17)
    assert (one >> 17 == two >> 17).all()


def test_every_passage_with_one_edit_is_found():
    item = [f"w{i}" for i in range(40)]
    pieces = Pieces([(1, " ".join(item))], 12, 1)
    for at in range(29):
        own = item[at : at + 12]
        assert pieces.find(" ".join(["x", *own, "y"]))[0][1] == 0
        for k in range(12):
            for changed in (own[:k] + ["new"] + own[k + 1 :], own[:k] + own[k + 1 :], own[:k] + ["new"] + own[k:]):
                got = pieces.find(" ".join(["x", *changed, "y"]))
                assert got and got[0][0] == 1 and got[0][1] <= 1, (at, k, changed)


def edit_brute(p, t):
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=70), st.lists(st.integers(0, 3), max_size=30))
def test_myers(p, t):
    assert myers(p, t) == edit_brute(p, t)


def brute_leak(text, item, n):
    w, p = words(text), words(item)
    grams = {tuple(p[i : i + n]) for i in range(len(p) - n + 1)}
    return any(tuple(w[i : i + n]) in grams for i in range(len(w) - n + 1))


def test_leaks_match_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([5, 12, 30, 60])))) for i in range(25)] + [(90, None), (91, ""), (92, "x " * 40)]
    docs = []
    for d in range(150):
        w = rng.choices(vocab, k=rng.randint(0, 80))
        p = words(rng.choice(items)[1])
        n = rng.choice([10, 11, 12, 13, 20])
        cut = p[(s := rng.randint(0, max(0, len(p) - n))) : s + n]
        if d % 3 == 0 and cut:
            cut[rng.randrange(len(cut))] = "typo"
        k = rng.randint(0, len(w))
        docs.append((d, rng.choice([", ", " ", "\n"]).join(w[:k] + [x.upper() for x in cut] + w[k:])))
    docs += [(500, None), (501, ""), (502, "x " * 30_000), (502, "x " * 30_000), (None, "x " * 20)]
    df, ev = spark.createDataFrame([(*d, "c") for d in docs], "doc_id bigint, text string, item_id string"), spark.createDataFrame(items, "item_id bigint, text string")
    out = find_leaks(df, ev).collect()
    got = {(r["doc_id"], r["item_id"]) for r in out if r["edits"] == 0}
    assert got == {(d, i) for d, t in docs if d is not None for i, p in items if brute_leak(t, p, 12)}
    assert len(out) == len({(r["doc_id"], r["item_id"]) for r in out})
    near = {(r["doc_id"], r["item_id"]) for r in out}
    ids = {d: words(t) for d, t in docs if d is not None}
    for d, i in [(d, i) for d, t in docs if d is not None and d < 60 for i, p in items if p]:
        p = words(dict(items)[i])
        want = any(edit_brute(p[s : s + 12], ids[d]) <= 1 for s in range(len(p) - 11))
        assert ((d, i) in near) == want
    assert find_leaks(df.limit(0), ev).count() == 0 and find_leaks(df, ev.limit(0)).count() == 0


def test_many_items_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr("trajlake.llm.leaks.ITEM_BYTES", 60)
    items = [(i, " ".join(f"a{i}b{j}" for j in range(14))) for i in range(6)]
    df = spark.createDataFrame([(i, t) for i, t in items], "doc_id bigint, text string")
    got = find_leaks(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["run_words"]) for r in got} == {(i, i, 14) for i in range(6)}


def test_mix_reaches_shares(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(["word"] * rng.randint(1, 30)), rng.choice(["A a", "a_a", "A-A "] * 4 + ["b", "B", "c", None])) for i in range(1500)]
    docs += [(9000, "", "b"), (9001, None, "b"), (None, "x", "b"), (9002, "y", "elsewhere")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, source string, tokens int")
    targets = spark.createDataFrame([("a_a", 0.2, 1), ("b", 0.5, 3), ("c", 0.2, 2), ("none", 0.1, 4)], "source string, target_share double, max_repeats int")
    chosen, report = mix_sources(df, targets)
    rows, shares = chosen.collect(), {r["source"]: r for r in report.collect()}
    assert set(shares) == {"a_a", "b", "c", "none"} and shares["none"]["mix_tokens"] == 0
    for s, cap in (("a_a", 1), ("b", 3), ("c", 2)):
        own = [r for r in rows if r["source"] == s]
        used = sum(r["tokens"] * r["copies"] for r in own)
        assert used == shares[s]["mix_tokens"] and max(r["copies"] for r in own) <= cap
        assert 0 <= shares[s]["budget"] - used <= 30
        assert abs(shares[s]["actual_share"] - {"a_a": 0.2, "b": 0.5, "c": 0.2}[s] / 0.9) < 0.02
    assert len({r["doc_id"] for r in rows}) == len(rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix_sources(df.repartition(5), targets)[0].collect()))
    big = {r["source"]: r for r in mix_sources(df, targets, total_tokens=10**7)[1].collect()}
    assert all(big[s]["most_copies"] == c for s, c in (("a_a", 1), ("b", 3), ("c", 2)))  # falls short, never repeats more
    assert mix_sources(df.limit(0), targets)[0].count() == 0


def test_tokens_round_trip():
    enc = load_tokenizer(TOKENIZER)
    for t in ("", "Grasp the <|endoftext|> peg, número 7 — straße\n\n", "　x" * 500):
        assert enc.decode(enc.encode_ordinary(t)) == t


def test_sentences_of_the_jvm(spark):
    rng = random.Random(9)
    parts = ["Straße", "ÉTÉ", "a1b", "x", "ＷＩＤＥ", "7.", "Dr.", "end!", "so…", '"said?"', "\n\n", "\n- ", "\n 2) ", "\n[3] ", "\n", "\u3000", "\u00a0", "w " * 21, "v " * 45, ".)", "?!"]
    texts = ["", " ", ".", None, "no end", "a " * 20, "a " * 21] + [rng.choice(["", " "]).join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["d"]: (list(r["sizes"]), r["words"].split(" ")) for r in subjects.tokens(df, "i", "t").collect()}
    want = {i: ([len(s) for s in sentences(t)], [w for s in sentences(t) for w in s]) for i, t in enumerate(texts) if sentences(t)}
    assert got == want


def test_sentences():
    assert sentences("One two. Three\n  four?\n\n- five\n- six 7 e8") == [["one", "two"], ["three", "four"], ["five"], ["six", "e"]]
    assert sentences(None) == [] == sentences(" 12 . ")
    assert [len(s) for s in sentences("a " * 33)] == [11, 11, 11]


TERMS = {"sea": ["harbour", "tide", "anchor", "vessel", "keel", "mast"], "bread": ["dough", "oven", "yeast", "flour", "crust", "loaf"], "law": ["court", "clause", "appeal", "statute", "verdict", "plea"]}
PLAIN = ["the {} and the {} again", "we saw that the {} meets the {} today", "compare the {} with the {} soon"]


def corpus(rng, n, terms):
    docs = []
    for i in range(n):
        about = rng.sample(sorted(terms), rng.choice([1, 1, 2]))
        lines = []
        for s in about:
            lines += [rng.choice(PLAIN).format(*rng.choices(terms[s], k=2)) for _ in range(6)]
        lines += ["please reply before monday"] * 2
        rng.shuffle(lines)
        docs.append((i, ". ".join(lines) + ".", about))
    return docs


def test_subjects_of_held_out_documents(spark):
    rng = random.Random(5)
    known = {s: t[:4] for s, t in TERMS.items()}  # the last two words of each subject are in no example
    examples = [(". ".join(rng.choice(PLAIN).format(*rng.choices(known[s], k=2)) for _ in range(4)) + ". please reply before monday.", s) for s in TERMS for _ in range(12)]
    examples += [(None, "sea"), ("x", None)]
    docs = corpus(rng, 500, TERMS)
    df = spark.createDataFrame([(i, t) for i, t, _ in docs] + [(900, None), (901, ""), (902, "please reply before monday."), (None, "the tide")], "doc_id bigint, text string")
    model = fit_subjects(df, spark.createDataFrame(examples, "text string, subject string"), Settings(steps=30))
    rows = score_subjects(df, model).collect()
    got = {(r["doc_id"], r["subject"]) for r in rows if r["share"] >= 0.25}
    want = {(i, s) for i, _, about in docs for s in about}
    assert len(got & want) / len(want) > 0.95 and len(got - want) / len(want) < 0.05
    assert not {d for d, _ in got} & {900, 901, 902, None}
    empty = fit_subjects(df, spark.createDataFrame([], "text string, subject string"))
    assert score_subjects(df, empty).count() == 0 and score_subjects(df.limit(0), model).count() == 0


def test_gradients_are_right():
    m = Model(["a", "b"], buckets=64, size=3)
    rows = [(np.array([1, 5, 9]), np.array([0.5, 0.25, 0.25]), np.array([1.0, 0.0]), 1.0), (np.array([5]), np.array([1.0]), np.array([0.0, 1.0]), 2.0)]
    own, g, out, bias, loss, _ = subjects.gradients(m, *subjects.packed(rows))
    for k, place in enumerate(own):
        m.embed[place, 1] += 1e-2
        up = subjects.gradients(m, *subjects.packed(rows))[4]
        m.embed[place, 1] -= 2e-2
        down = subjects.gradients(m, *subjects.packed(rows))[4]
        m.embed[place, 1] += 1e-2
        assert (up - down) / 2e-2 == pytest.approx(g[k, 1], abs=2e-3)


def test_pieces_need_room():
    with pytest.raises(ValueError):
        Pieces([], 3, 9)


def test_one_wrong_word_is_found_wherever_it_is():
    item = [f"w{i}" for i in range(40)]
    pieces = Pieces([(1, " ".join(item))], 12, 1)
    for start in range(4, 8):  # every alignment to the pieces of four words
        for wrong in range(12):
            text = [*item[start : start + wrong], "other", *item[start + wrong + 1 : start + 12]]
            assert [x[:2] for x in pieces.find(" ".join(text))] == [(1, 1)], (start, wrong)


def test_mix_does_not_depend_on_the_ranges(spark, monkeypatch):
    from trajlake.llm import mix

    df = spark.createDataFrame([(i, "word " * (1 + i % 7), "ab"[i % 5 == 0]) for i in range(600)], "doc_id bigint, text string, source string")
    goal = spark.createDataFrame([("a", 0.5, 3), ("b", 0.5, 3)], "source string, target_share double, max_repeats int")
    take = lambda: sorted(map(tuple, mix_sources(df, goal, total_tokens=1500)[0].collect()))
    want = take()
    for bits, rows in ((1, 1 << 16), (2, 20), (20, 1)):
        monkeypatch.setattr(mix, "RANGE_BITS", bits)
        monkeypatch.setattr(mix, "RANGE_ROWS", rows)
        assert take() == want
