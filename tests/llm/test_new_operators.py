"""Ranked search, spelling variants and mixing against brute force on small tables with odd rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from unittest import mock

import pyarrow as pa
import pytest

from reviewgrove.llm import mixing, ranked_search, spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]+")
RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string, source string, term string, n long, row string, key string, part string, taken string, rank string"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, s, "x", 1, "r", None, "p", "t", "k") for i, t, s in rows], SCHEMA).repartition(3)


# Ranked search


def plain_search(docs, items, top=10):
    terms = [(i, TERM.findall((t or "").translate(LOW))) for i, t, _ in docs]
    counted = [(i, Counter(w), len(w)) for i, w in terms if w]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    bags = {}
    for item, text in {(i, t) for i, t in items if i is not None}:
        bags.setdefault(item, Counter()).update(TERM.findall((text or "").translate(LOW)))
    out = []
    for item, bag in bags.items():
        scores = []
        for i, counts, n in counted:
            m = 100 - 75 + 75 * n * n_docs // total
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t, q in bag.items()
                if t in counts
            )
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(80)] + ["Éclair", "ÉCLAIR", "x1y2", "中文", "it's"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))), None) for i in range(150)]
    docs += [(200, None, None), (201, "", None), (202, " ., ", None), (None, "w1 w2 w3", None), (203, "w1 " * 30000, None)]
    docs += [(204, "w5 w6", None), (205, "w5 w6", None), (204, "w5 w6", None)]
    items = [(k, " ".join(rng.choice(words) for _ in range(20))) for k in range(12)]
    items += [(20, None), (21, ""), (22, "nowhere"), (None, "w1"), (23, "w5 w5 w6"), (23, "w5 w5 w6"), (23, "w7"), (24, items[0][1])]
    return docs, items


def test_search_equals_brute_force(spark, corpus):
    docs, items = corpus
    asked = spark.createDataFrame([(*item, "x") for item in items], "item_id int, text string, q string")
    assert sorted(map(tuple, ranked_search.search(frame(spark, docs), asked).collect())) == plain_search(docs, items)
    with mock.patch.object(ranked_search, "BLOCK_TERMS", 60), mock.patch.object(ranked_search, "SCORE_BYTES", 4000):
        assert sorted(map(tuple, ranked_search.search(frame(spark, docs), asked).collect())) == plain_search(docs, items)


def test_search_without_rows(spark, corpus):
    docs, items = corpus
    asked = spark.createDataFrame(items, "item_id int, text string")
    assert ranked_search.search(frame(spark, docs), asked.limit(0)).count() == 0
    assert ranked_search.search(frame(spark, docs[:0]), asked).count() == 0


def test_sharing_graph_adds_up_and_saves():
    rng = random.Random(1)
    common = [[(t, 1) for t in rng.sample(range(60), 12)] for _ in range(5)]
    items = [sorted({*rng.choice(common), *rng.choice(common), (rng.randrange(60), 2)}) for _ in range(40)]
    graph = ranked_search.sharing_graph(items)

    def leaves(node):
        if node < len(graph.leaves):
            return [graph.leaves[node]]
        a, b = graph.parts[node - len(graph.leaves)]
        assert max(a, b) < node
        return leaves(a) + leaves(b)

    assert [sorted(leaf for node in nodes for leaf in leaves(node)) for nodes in graph.items] == items
    assert graph.additions() < sum(len(item) - 1 for item in items) // 2


# Spelling


def plain_variants(docs):
    counts = Counter()
    for i, text, _ in docs:
        for run in RUN.findall(text or ""):
            low = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 31 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1 :]
            counts[low] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    less = {}
    for w in counts:
        for k in range(len(w)):
            less.setdefault(w[:k] + w[k + 1 :], set()).add((w, k))
    near = {w: set() for w in counts}
    for short, own in less.items():
        for w, k in own:
            near[w] |= {v for v, j in own if j == k and v != w}
            if short in counts:
                near[w].add(short)
                near[short].add(w)
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * n:
            forms[w] = best

    def root(w):
        return root(forms[w]) if w in forms else w

    return sorted((w, forms.get(w), root(w), n, len(near[w]), counts.get(forms.get(w))) for w, n in counts.items())


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def spelled():
    rng = random.Random(5)
    base = ["information", "Étranger", "naïveté", "aaaaaaaa", "abababab", "wonderful", "straßen", "×÷×÷×÷×"]
    words = []
    for word in base:
        words += [word] * 260 + [word[:-1]] * 3 + [word + "s"] * 25 + [word + word[-1]] * 2 + [word + "st"] * 2
        for _ in range(12):
            k = rng.randrange(len(word))
            letter = rng.choice("abceéz")
            words += [rng.choice([word[:k] + letter + word[k:], word[:k] + letter + word[k + 1 :], word[:k] + word[k + 1 :]])] * 2
    # Runs that are longer than what the levels reach, one edit apart, at both ends and inside.
    for size in (70, 400, 3000):
        run = "".join(rng.choice("abcd") for _ in range(size))
        for k in (0, size // 3, size // 2, size - 1):
            words += [run[:k] + "z" + run[k + 1 :]] * 2 + [run[:k] + run[k + 1 :]] * 2 + [run[:k] + "q" + run[k:]] * 2
        words += [run] * 40
    rng.shuffle(words)
    docs = [(i, " ".join(words[i * 40 : i * 40 + 40]) + (". 9" if i % 2 else "\n"), None) for i in range(len(words) // 40 + 1)]
    return docs + [(900, None, None), (901, "", None), (902, "12 short", None), (None, "information wonderful", None), docs[0]]


def test_variants_equal_brute_force(spark):
    docs = spelled()
    expected = plain_variants(docs)
    assert any(form for _, form, *_ in expected) and any(r not in (w, f) for w, f, r, *_ in expected)
    assert rows_of(spelling.variants(frame(spark, docs))) == expected


def test_variants_without_words(spark):
    assert spelling.variants(frame(spark, [])).count() == 0
    assert spelling.variants(frame(spark, [(1, None, None), (2, "short", None)])).count() == 0
    alone = spelling.variants(frame(spark, [(1, "lonesome lonesome", None)]))
    assert rows_of(alone) == plain_variants([(1, "lonesome lonesome", None)])


def test_checksums_and_letters():
    import numpy as np

    data = np.frombuffer("aÿÀ×b Ā9".encode(), np.uint8)
    assert spelling.letters(data).tolist() == [True, True, True, True, True, True, True, True, False, False, False, False]
    text = b"abc" * 50
    whole = np.frombuffer(text, np.uint8)
    starts, ends = np.array([0, 3, 10, 149]), np.array([1, 9, 150, 150])
    begun = np.array([zlib.crc32(b"7:"), 0, zlib.crc32(b"12:"), 5], np.uint32)
    expected = [zlib.crc32(text[s:e], int(b)) for s, e, b in zip(starts, ends, begun)]
    assert spelling.checksums(whole, starts, ends, begun).tolist() == expected


def test_paths_of_words():
    paths = spelling.Paths(pa.array(["größe", "größer"], pa.large_string()), 0)
    assert paths.node(paths.places(paths.lengths * 0, paths.lengths * 0 + 1)[0], 5).tolist()[0] == paths.nodes[5]
    assert paths.nodes[5] == paths.nodes[7 + 5] and paths.nodes[6] != paths.nodes[7 + 6]
    assert len(set(paths.end().tolist())) == 2


# Mixing


def plain_targets(sizes, most=3):
    """By rounds, as the contract words it, in fractions."""
    from fractions import Fraction

    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest, all_weights = total - sum(fixed.values()), sum(weights[s] for s in free)
        aims = {s: Fraction(rest * weights[s], all_weights) for s in free}
        above = [s for s in free if aims[s] > most * sizes[s]]
        if not above:
            return {**{s: Fraction(v) for s, v in fixed.items()}, **aims}
        fixed.update({s: most * sizes[s] for s in above})


def mixed_documents():
    rng = random.Random(11)
    docs, at = [], 0
    for k, source in enumerate(["b", "a", None, "Z", "é", "", "empty", "tiny", "c", "d"]):
        for _ in range(300 if source == "a" else 3 + 7 * k):
            words = rng.randint(0, 40) if source != "empty" else 0
            docs.append((at, " ".join(["w"] * words) if source != "tiny" else "one", source))
            at += 1
    docs += [(at, None, "a"), (None, "no number here", "a"), (None, "no number here", "a"), (at + 1, "w " * 5000, "b"), docs[0], docs[0]]
    return docs


def test_mix_meets_every_target(spark):
    docs = mixed_documents()
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(VISIBLE.findall(text or ""))
    aims = plain_targets(sizes)
    found = mixing.mix(frame(spark, docs), ["doc_id", "source", "row"]).collect()
    assert len(found) == len(docs) and {r.row for r in found} == {"r"}
    taken = Counter()
    partial = Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, aims[r.source], abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        partial[r.source] += bool(r.size and r.taken % r.size)
    assert taken == Counter({s: math.floor(aim) for s, aim in aims.items()}) and max(partial.values()) <= 1
    again = mixing.mix(frame(spark, docs).repartition(7), ["doc_id", "source", "row"]).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    digest = mixing.mixture(frame(spark, docs))
    assert digest.columns == ["doc_id", "size", "source_size", "target", "taken"] and digest.count() == len(docs)


def test_mixed_texts(spark):
    docs = mixed_documents()
    rows = mixing.mixed_texts(frame(spark, docs)).collect()
    taken = Counter()
    for r in rows:
        assert len(VISIBLE.findall(r.text)) == r.n_taken and 1 <= r.epoch <= 3 and r.taken == "t"
        taken[r.doc_id] += r.n_taken
    expected = Counter()
    for r in mixing.mix(frame(spark, docs), ["doc_id"]).collect():
        expected[r.doc_id] += r.taken
    assert +expected == +taken


def test_mix_without_words(spark):
    assert mixing.mixture(frame(spark, [])).count() == 0
    rows = mixing.mixture(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_mix_is_native(spark, sf_dir):
    plan = mixing.mixture(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# Token ids with a small table


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_with_a_table_that_overflows(monkeypatch, name):
    from tokenizers import Tokenizer

    from reviewgrove.llm import tokens
    from reviewgrove.llm.queries import tokenizer

    monkeypatch.setattr(tokens, "TABLE_BYTES", 3000)
    monkeypatch.setattr(tokens, "PIECES_BYTES", 2000)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 500)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeéß,.") for _ in range(rng.randint(1, 9))) for _ in range(300)] + ["q" * 300, "漢字" * 200, "9" * 400]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + rng.choice(["", " ", "\n"]) for _ in range(150)]
    texts += [rng.choice("  a") + "b" * 20000, " ".join(words), None]
    library = Tokenizer.from_file(tokenizer(name))
    coder = tokens.Encoder(tokenizer(name))
    monkeypatch.setitem(tokens.process_store(), ("encoder", tokenizer(name)), coder)
    at = 0
    for first, last, ids, counts in tokens.encoded(pa.array(texts), tokenizer(name), 1):
        expected = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts[first:last]]
        assert first == at and counts.tolist() == list(map(len, expected)) and ids.tolist() == [i for own in expected for i in own]
        at = last
    assert at == len(texts) and coder.known.nbytes() < 12000 and coder.pieces_bytes <= 2000


def test_known_ids_make_room():
    import numpy as np

    from reviewgrove.llm import tokens

    known = tokens.Known(400)
    rng = random.Random(3)
    for _ in range(60):
        keys = np.array(sorted(rng.sample(range(200), 8)), np.uint64)
        at = known.find(keys)
        for key, place in zip(keys.tolist(), at.tolist()):
            if place >= 0:
                start, size = known.starts[place], known.sizes[place]
                assert known.ids[start : start + size].tolist() == [key] * (key % 4)
        new = keys[at < 0]
        known.add(new, [np.full(int(k) % 4, k, np.uint32).tobytes() for k in new])
        assert known.nbytes() <= 800 and (np.diff(known.keys.astype(np.int64)) > 0).all()
