"""The operators' small parts against plain rewritings of their definitions."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import decontaminate, licenses, lines, packing, paragraphs, simhash, toxicity, urls, vectors
from shelfmark.llm.common import ALNUM, SPACED, texts, word_hashes, words
from shelfmark.llm.logistic import fit

TEXT = st.text(st.sampled_from("abAB é\n\t.,9ß"), max_size=40)


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.none() | TEXT, max_size=6))
def test_words_of_blocks(rows):
    batch = pa.record_batch([pa.array(rows, pa.string())], names=["text"])
    for kind, pattern in ((SPACED, "[^\x20\x09-\x0d]+"), (ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        found, hashes = [], {}
        for _, data, offsets in texts(batch):
            raw = data.tobytes()
            starts, ends, first = words(data, offsets, kind)
            for w, h in zip((raw[a:b] for a, b in zip(starts, ends)), word_hashes(data, starts, ends).tolist()):
                assert hashes.setdefault(w, h) == h
            found += [[raw[a:b].decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(first, first[1:])]
        assert found == [re.findall(pattern, low(t or "")) for t in rows]
        assert len(set(hashes.values())) == len(hashes)


def plain_simhash(text):
    found = re.findall("[^\x20\x09-\x0d]+", low(text))
    if not found:
        return 0
    runs = [" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(deadline=None, max_examples=60)
@given(TEXT)
def test_fingerprint(text):
    batch = pa.record_batch([pa.array([text])], names=["text"])
    found = 0
    for _, data, offsets in texts(batch):
        starts, ends, _ = words(data, offsets, SPACED)
        found = simhash.fingerprint(data.tobytes(), starts, ends, 3)
    assert found % (1 << 64) == plain_simhash(text)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@settings(deadline=None, max_examples=400)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12), st.integers(0, 4))
def test_edit_distance_and_buckets(a, b, most):
    near = plain_distance(a, b) <= most
    assert lines.within(a, b, most) == near
    if near and min(len(a), len(b)) > most:
        assert set(lines.keys(a, most, {})) & set(lines.keys(b, most, {}))
    for q in (1, 2, 4):
        one, two = lines.grams(a, q), lines.grams(b, q)
        if near and len(one) > q * most and len(two) > q * most:
            # whatever the order of the runs, here that of their digests
            assert set(sorted(one)[: q * most + 1]) & set(sorted(two)[: q * most + 1])
            assert len(one - two) <= q * most


def test_suffix_array():
    rng = np.random.default_rng(1)
    for n, letters in ((1, 1), (7, 2), (300, 3), (400, 40)):
        line = rng.integers(0, letters + 1, n)
        order = decontaminate.suffix_array(line, n)
        assert order.tolist() == sorted(range(n), key=lambda k: [*line[k:].tolist()])


def test_matches_against_all_windows():
    rng = random.Random(3)
    items = [(k, " ".join(rng.choices("abcd", k=n))) for k, n in enumerate([0, 1, 2, 3, 4, 6, 8, 8])]
    rows = [" ".join(rng.choices("abcde", k=n)) for n in [0, 1, 2, 5, 30, 60]] + ["B. a-C", ""]
    tests = decontaminate.prepared(items, 4)
    batch = pa.record_batch([pa.array(rows)], names=["text"])
    for _, data, offsets in texts(batch):
        n, found = decontaminate.matches(data, offsets, tests, 8)
    for k, text in enumerate(rows):
        line = re.findall("[a-z0-9]+", text.lower())
        hit, ids = set(), set()
        for i, t in items:
            w = t.split()
            size = min(4, len(w))
            for x in range(len(w) - size + 1 if w else 0):
                for y in range(len(line) - size + 1):
                    if line[y : y + size] == w[x : x + size]:
                        hit |= set(range(y, y + size))
                        ids.add(str(i))
        assert n[k] == len(line)
        assert decontaminate.covered(found[k]) == len(hit)
        assert {i for *_, i in found[k]} == ids


@pytest.mark.parametrize("text", [
    "", "It's  A test\n", "naïve Straße ÉCOLE ſ", "á é", "don't we'll 12 3½ x²", "!!'s ~~ <|endoftext|>", "日本 語 Привет ΑΣ",
    "hello <|endoftext|> world", "<|startoftext|><|endoftext|>", "İstanbul ǅ", "a b​c\x1cd\x85e", "“q” – … ¿no?", "x" * 300,
])
def test_word_ids_equal_the_tokenizer(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    known = packing.WordIds(path)
    for _ in range(2):
        assert np.frombuffer(known.of(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_word_ids_of_many_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, chance = Tokenizer.from_file(path), random.Random(9)
    kinds = ["abcdefghij ", "ab'srelvtmd ", "été ÀÉß1290 ", "x<|>endoftext| ", "日本 a\n", "'\".,;:!?-–“ a", "aA \t\r\n\u2028\x0b"]
    texts = ["".join(chance.choice(k) for _ in range(chance.randint(0, 200))) for k in kinds for _ in range(150)]
    texts += ["a <|endoftext|> b", "<|STARTOFTEXT|>x", "e\u0301 \u0130", "y" * 9000, "it's 'Twas we'LL"]
    known = packing.WordIds(path)
    texts += ["".join(chr(c) for c in range(33, 383) if packing._PLAIN.fullmatch(chr(c))), "é è ë ÿ Ā ſ ß ŉ Ž «x»"]
    for text in texts:
        assert np.frombuffer(known.of(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(5)
    for n in (0, 1, 7, 3000):
        sizes, counts = np.unique(rng.integers(1, 129, n), return_counts=True)
        counted = dict(zip(sizes.tolist(), counts.tolist()))
        made = packing.plan(counted, 512)
        used = {}
        for pattern, often in made:
            assert sum(pattern) <= 512
            for s in pattern:
                used[s] = used.get(s, 0) + often
        assert used == counted
        if n == 3000:
            total = sum(s * c for s, c in counted.items())
            assert sum(o for _, o in made) <= total / 512 * 1.01 + 1


def test_robust_graph_walk_finds_what_is_in_range():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16))
    x[200:400] = x[0] + rng.normal(size=(200, 16)) * 0.05
    x = vectors.unit(x).astype(np.float32)
    i, k = vectors.range_search(x, vectors.robust_graph(x, 16, 48, 1.2), x, 0.95, 32)
    truth = x @ x.T >= 0.95
    got = set(zip(i.tolist(), k.tolist()))
    wanted = set(zip(*(v.tolist() for v in np.nonzero(truth))))
    assert len(wanted & got) >= 0.95 * len(wanted)


def test_digest_array_confirms_strings():
    known = urls.DigestArray(["a", "b/", ""])
    assert (known.places([b"a", b"b", b"b/", b""]) >= 0).tolist() == [True, False, True, True]
    known.digests = np.sort(np.concatenate([known.digests[:0], np.full(3, xxhash.xxh64_intdigest(b"zz"), dtype="<u8")]))
    assert known.places([b"zz"]).tolist() == [-1]
    assert urls.DigestArray([]).places([b"a"]).tolist() == [-1]


def test_longest_rule_of_host_and_path():
    rules = [urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"), urls.Rule("block", "x.example.net/")]
    known = urls.DigestArray({r.host + r.path for r in rules})
    hosts = ["a.example.net", "example.net", "x.example.net", "xnet", "net", ""]
    paths = ["/en/1", "/e", "/en/", "/", "", "/"]
    assert urls.longest_rules(hosts, paths, rules, known) == ["example.net/en/", "net/", "example.net/en/", None, None, None]


def written(tree, options):
    """The strings a parsed pattern of words matches: all alternatives, with what is optional or without."""
    out = [""]
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            parts = [chr(value)]
        elif name == "AT":
            parts = [""]
        elif name == "IN":
            parts = [chr(v) for _, v in value]
        elif name == "SUBPATTERN":
            parts = written(value[-1], options)
        elif name == "BRANCH":
            parts = [x for branch in value[1] for x in written(branch, options)]
        else:
            assert name == "MAX_REPEAT" and value[:2] == (0, 1)
            parts = written(value[2], options) if options else [""]
        out = [a + b for a in out for b in dict.fromkeys(parts)]
    return out


def test_every_alternative_of_every_license_rule_passes_the_gate():
    from re import _parser

    rules = licenses.rules()
    gate = licenses.gate(rules)
    for k, rule in enumerate(rules):
        for options in (False, True):
            for line in written(_parser.parse(rule.pattern.pattern), options):
                if rule.pattern.fullmatch(line):
                    assert any(w.decode() in line for w in licenses._NEEDED), line
                    assert k in {n for _, ns in gate.iter(line) for n in ns}, line
    found = {t: [d.label for d in licenses.detect(t, rules, gate)] for t in (
        "released under the mit", "distributed under expat", "released under asl 2 0", "the psf license", "released under wtfpl",
        "creative commons attribution license", "creative commons zero license")}
    assert list(found.values()) == [["mit"], ["mit"], ["apache-2.0"], ["python"], ["wtfpl"], ["cc-by"], ["cc0"]]


def test_license_rules():
    rules = licenses.rules()
    gate = licenses.gate(rules)
    assert len(rules) >= 250

    def labels(line):
        return [d.label for d in licenses.detect(line, rules, gate)]

    assert labels("licensed under the apache license version 2 0") == ["apache-2.0"]
    assert labels("released under the mit license and gplv3 x") == ["mit"]
    assert labels("this is the gnu general public license version 3") == ["gpl-3"]
    assert labels("spdx license identifier bsd 3 clause") == ["bsd-3-clause"]
    assert labels("no license at all") == []
    assert licenses.base_places(" mit license mit license ") == ([0, 2], {"mit"})


def test_folding_and_exceptions():
    assert toxicity.folded("Ѕtuріd 1d10t, $cum!") == " stupid idiot scum "
    assert toxicity.folded("2024 a.b") == " 2024 a b "
    known = toxicity.automaton({" idiot ": 4.0, " scum ": 4.0, " ic ": 3.0})
    assert toxicity.evidence(known, "an idiot")[2] > 0
    assert toxicity.evidence(known, "ic " * 40)[1:] == (120.0, 3.0, 1.0)
    assert toxicity.evidence(known, "an idiot proof box, pond scum")[1] == 0
    assert toxicity.evidence(known, "idiotic")[1] == 0
    assert toxicity.evidence(known, "")[1:] == (0.0, 0.0, 0.0)


def test_logistic():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 2))
    y = (x[:, 0] - 0.5 + rng.normal(size=2000) * 0.1 > 0).astype(int)
    intercept, slopes = fit(x, y)
    assert (((x @ slopes + intercept) > 0) == y).mean() > 0.95
    assert fit(x, np.ones(2000))[1] is None


def test_anchors_of_shared_words():
    rng = np.random.default_rng(6)
    shared = rng.integers(0, 1 << 60, 50).astype(np.uint64)
    keys = []
    for n in (0, 13, 200):
        line = np.concatenate([rng.integers(0, 1 << 60, n), shared, rng.integers(0, 1 << 60, 31)]).astype(np.uint64)
        keys.append(set(paragraphs.anchors(line, 25, 26)[1].tolist()))
    assert keys[0] & keys[1] & keys[2]


def test_cut_out():
    assert paragraphs.cut_out("a b  c d\ne", [{"start": 1, "end": 3}, {"start": 2, "end": 4}]) == "a e"
    assert paragraphs.cut_out(None, []) is None


def test_lexicon_evidence_against_every_place():
    """All places of all terms, longest first from each start; what lies inside an earlier one is hidden."""
    chance = random.Random(12)
    pieces = ["ab", "abc", "b", "bc", "c a", "ab b", "abcab"]
    for _ in range(300):
        lexicon = {f" {p}" + chance.choice(["", " "]): chance.choice([0.0, 1.0, 2.5]) for p in chance.sample(pieces, 4)}
        text = " ".join("".join(chance.choice("abc") for _ in range(chance.randint(1, 5))) for _ in range(chance.randint(0, 12)))
        line, hits = toxicity.folded(text), []
        for term, weight in lexicon.items():
            hits += [(at, -(at + len(term) - 1), weight, term) for at in range(len(line)) if line.startswith(term, at)]
        total, top, names, reach = 0.0, 0.0, set(), -1
        for _, end, weight, term in sorted(hits):
            last = -end - term.endswith(" ")
            if last > reach and weight > 0:
                total, top = total + weight, max(top, weight)
                names.add(term)
            reach = max(reach, last)
        assert toxicity.evidence(toxicity.automaton(lexicon, ()), text)[1:] == (total, top, len(names))


def test_edit_distance_of_long_lines_takes_runs_at_a_time():
    line = "".join(np.random.default_rng(5).choice(list("abcdefgh"), 200_000))
    other = line[:500] + line[501:150_000] + "x" + line[150_000:]
    began = time.process_time()
    assert all(lines.within(line, other, 2) and not lines.within(line, "y" + other[1:], 2) for _ in range(20))
    assert time.process_time() - began < 2
