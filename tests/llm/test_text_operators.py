"""Decontamination, language, tokens, secrets, chat and URLs against brute force and the libraries."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from varframe.llm import bpe, chat, decontaminate, language_id, secrets, token_counts, url_filter, words

HARD = [None, "", " ", "a", "  a", "a  ", "\n\n a", "don't we'll I'VE 's's ''s", "<|endoftext|>", "x<|endoftext|> y <|endoftext|>", "é漢字😀",
        "\u3000\xa0 \x85", "12 3٣ ½", "a" * 300, " " * 50 + "b", "\x1c\x1d", "### Assistant: </turn> \\ ok", "ſecret", "tab\t\ttab"]


def mixed(seed, n):
    rng = random.Random(seed)
    pool = list("abcdest 'mrvl  \n\t12é漢😀!?.<|>") + ["<|endoftext|>", "'s", " the", "ing", "   "]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, spans string, ids string, n_words long")


# ------------------------------------------------------------------ BPE

def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.tokenizer_file())
    texts = HARD + mixed(1, 3000) + mixed(1, 5)
    got = bpe.encode_documents(frame(spark, texts), bpe.tokenizer_file()).select("doc.doc_id", "ids", "decoded").collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids, texts[r.doc_id]
        assert r.decoded == library.decode(ids, skip_special_tokens=False) == (texts[r.doc_id] or "")


def test_long_texts_are_cut_between_words():
    encoder = bpe.Encoder(bpe.compile_file(open(bpe.tokenizer_file(), encoding="utf-8").read()))
    texts = mixed(2, 300) + ["word " * 500, "x" * 2000]
    whole, at = encoder.encode(texts)
    encoder.SEGMENT = 20
    parts, at2 = encoder.encode(texts)
    assert (whole == parts).all() and (at == at2).all()
    encoder.limit = 10
    assert (encoder.encode(texts)[0] == whole).all()


@pytest.mark.parametrize("seed", range(6))
def test_automaton_against_merging_by_hand(seed):
    rng = random.Random(seed)
    vocabulary = {bytes([c]): i for i, c in enumerate(b"abc")}
    merges = []
    for _ in range(25):
        a, b = rng.choice(list(vocabulary)), rng.choice(list(vocabulary))
        if len(a + b) <= 9 and a + b not in vocabulary:
            vocabulary[a + b] = len(vocabulary)
            merges.append((a, b))
    machine = bpe.Automaton(vocabulary, merges, {})

    def by_hand(word):
        parts = [bytes([c]) for c in word]
        while True:
            best = min(((merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in merges), default=None)
            if best is None:
                return [vocabulary[p] for p in parts]
            a, b = merges[best[0]]
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == (a, b):
                    out.append(a + b)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out

    for _ in range(400):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 16)))
        assert machine.encode_word(word) == by_hand(word)
        assert machine.decode(machine.encode_word(word)) == word


def test_bpe_of_an_empty_table(spark):
    assert bpe.encode_documents(frame(spark, ["a"]).limit(0), bpe.tokenizer_file()).count() == 0


# ------------------------------------------------------------------ unigram counts

def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces, unknown = token_counts.vocabulary(token_counts.model_file())
    library = Tokenizer(models.Unigram(pieces, unk_id=unknown, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.MARK, prepend_scheme="always")
    texts = HARD + mixed(3, 2000) + ["▁▁ a", "<unk>漢<unk>", "<0x0A>"]
    got = token_counts.token_counts(frame(spark, texts), token_counts.model_file()).select("doc.doc_id", "n_tokens").collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_counts_with_ties_and_without_bytes():
    from tokenizers import Tokenizer, models

    rng = random.Random(5)
    for _ in range(30):
        pieces = [("<unk>", 0.0)] + [(p, float(-rng.randint(1, 3))) for p in {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(6)}]
        library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
        counter = token_counts.Counter(pieces, 0)
        for _ in range(100):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
            assert counter.count_word(word) == len(library.encode(word).ids), (pieces, word)


# ------------------------------------------------------------------ language

def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = language_id.op7_language_id(spark, sf).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_language_edges(spark):
    learned = {x: language_id.in_order(*language_id.ngram_counts(t), language_id.PROFILE)
               for x, t in (("aa", "der die das und ist nicht"), ("bb", "the and that is not this"))}
    df = frame(spark, [None, "", "12 !? \n", "the that", "der das nicht " * 9000, "漢字", "the that"])
    got = {r.doc_id: r for r in language_id.identify(df, learned).select("doc.doc_id", "lang_pred", "score").collect()}
    assert [got[i].lang_pred for i in range(7)] == ["und", "und", "und", "bb", "aa", "aa", "bb"]
    assert got[0].score == got[2].score == 0 and got[3] != got[4] and got[3].score == got[6].score
    assert language_id.identify(df, {}).filter("lang_pred = 'und'").count() == 7
    assert language_id.learn(df.limit(0).withColumn("lang", F.lit("x"))) == {}


def test_ngrams_by_hand(monkeypatch):
    def by_hand(text):
        out = collections.Counter()
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            w = [0, *[ord(c) for c in w], 0]
            out.update((3 << 62) | c for c in w[1:-1])
            out.update((1 << 63) | (a << 21) | b for a, b in zip(w, w[1:], strict=False))
            out.update((a << 42) | (b << 21) | c for a, b, c in zip(w, w[1:], w[2:], strict=False))
        return dict(out)

    text = "Été, a bb-ccc 12 DDD x漢字"
    as_dict = lambda pair: dict(zip(*[x.tolist() for x in pair], strict=True))
    assert as_dict(language_id.ngram_counts(text)) == by_hand(text)
    monkeypatch.setattr(language_id, "SEGMENT", 6)
    assert as_dict(language_id.ngram_counts(text)) == by_hand(text)


# ------------------------------------------------------------------ decontamination

def contamination_brute(texts, items, size):
    wins = collections.defaultdict(set)
    for item, text in items:
        w = words.split(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins[tuple(w[i : i + size])].add(str(item) if item is not None else None)
    out = {}
    for i, t in enumerate(texts):
        w, hit, found = words.split(t), set(), set()
        for win, ids in wins.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    found |= ids
        out[i] = (len(w), len(hit), sorted(found - {None}), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block", [1 << 20, 256])  # with 256 bits nearly every word is a candidate
def test_contamination(spark, block):
    rng = random.Random(6)
    some = lambda n: " ".join(rng.choice(["a", "b", "the", "É", "x1"]) for _ in range(n))
    items = [(i, some(rng.randint(1, 9))) for i in range(12)] + [(40, None), (41, "?!"), (42, "zz"), (3, "The, B"), (None, "b b b"), (42, "zz")]
    texts = [some(rng.randint(0, 60)) for _ in range(40)] + [None, "", "ZZ", "zz " * 50, "."]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame(spark, texts), bench, size=4, filter_bits=block).collect()
    assert {r.doc.doc_id: (r.n_words, r.n_hit, r.items, r.contaminated) for r in got} == contamination_brute(texts, items, 4)
    assert got[0].doc.spans == "x"


def test_contamination_without_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(frame(spark, ["a b", None]), none).collect()
    assert sorted((r.n_words, r.n_hit, r.contaminated) for r in got) == [(0, 0, False), (2, 0, False)]
    assert decontaminate.contamination(frame(spark, ["a"]).limit(0), none).count() == 0


# ------------------------------------------------------------------ secrets

def test_base_spans_by_hand():
    assign = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    rng = random.Random(7)
    pool = ["token", "PassWord", "api_key", "apikey", "=", ": ", '"', "'", "abcdef012345", "0123456789abcdef", "AKIA", "ABCDEFGHIJ", " ", "\n", "ſ", "é", "."]
    for _ in range(3000):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))
        want = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m.group(2)) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 16]
        assert secrets.base_spans(t) == sorted(want)


def test_random_strings_are_added(spark):
    rng = random.Random(8)
    key = lambda n: "".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(n))
    texts = [f"the configuration of something ordinary and token={key(90)} follows understandable identifiers_everywhere" for _ in range(200)]
    texts += [f"see {key(40)} here", "an_ordinary_identifier_that_follows_something", None, "", "see nothing"]
    df = frame(spark, texts)
    ratios = secrets.train(df)
    got = {r.doc_id: [tuple(x) for x in r.found] for r in secrets.scan(df, ratios).select("doc.doc_id", F.col("spans").alias("found")).collect()}
    assert got[200] == [("random", 4, 44)] and got[201] == got[202] == got[203] == got[204] == []
    assert all(len(got[i]) == 1 and got[i][0][0] == "assign" for i in range(200))
    assert secrets.train(df.limit(0)) is None
    assert secrets.scan(df, None).filter(F.size("spans") > 1).count() == 0


def test_keys_are_found_when_only_hex_is_known(spark, sf):
    rng = random.Random(12)
    key = lambda n, of=secrets.ALPHABET[:62]: "".join(rng.choice(of) for _ in range(n))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    makers = [lambda: key(40), lambda: "ghp_" + key(36), lambda: "some/ordinary/folder/with/understandable/names/" + key(32),
              lambda: key(43, secrets.ALPHABET[:62] + "+/") + "=", lambda: key(32, secrets.ALPHABET[26:52] + "234567")]
    planted = [make() for make in makers for _ in range(100)]
    beside = [f"AKIA{key(16, secrets.ALPHABET[:26])}/{key(40)}" for _ in range(50)]
    plain = ["an_ordinary_identifier_that_follows_something", "/with/understandable/names/of/folders/in/between", "UnderstandableNamesOfSomethingOrdinary"]
    once = None
    for copies in (1, 30):  # more training data must not lose keys
        ratios = secrets.train(docs.crossJoin(spark.range(copies).select(F.col("id").alias("doc_id"))))
        found = [secrets.all_spans(f"see {t} here", ratios) == [(4, 3, 4 + len(t))] for t in planted]
        assert all(sum(found[i : i + 100]) >= 80 for i in range(0, 500, 100))
        assert once is None or sum(found) >= once - 5
        once = sum(found)
        assert sum(secrets.all_spans(t, ratios) == [(0, 1, 20), (20, 3, 61)] for t in beside) >= 45
        assert not any(secrets.all_spans(t, ratios) for t in plain)


# ------------------------------------------------------------------ chat

def test_chat_round_trip(spark):
    texts = [t for t in HARD] + mixed(9, 200) + ["\\### Assistant: </turn> ok", "\\\\:", "### a: b</turn>\n### user: c</turn>\n"]
    rng = random.Random(10)
    rows = [(i // 7 if i % 50 else None, i, rng.choice(["user", "assistant", "system", None, "a: b", "###"]), t) for i, t in enumerate(texts)]
    rows += [(1000, 1, "assistant", "same"), (1000, 1, "assistant", "same"), (1000, None, "user", "first"), (1000, 1, "user", "b"), (1000, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("x")).withColumn("mask", F.lit(1))
    turns = chat.format_turns(df.repartition(5), bpe.tokenizer_file())
    got = {r.conv_id: r for r in chat.read_back(turns, bpe.tokenizer_file()).collect()}
    talks = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(talks)
    for conv, talk in talks.items():
        talk.sort()
        said = "".join(t for _, r, t in talk if r == "assistant")
        assert got[conv].n_turns == len(talk) and got[conv].loss_chars == len(said)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in talk).encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    places = turns.filter("conv_id = 1000").orderBy("token_start").collect()
    assert [p.token_start for p in places] == np.cumsum([0, *[len(p.ids) for p in places[:-1]]]).tolist()
    assert chat.read_back(chat.format_turns(df.limit(0), bpe.tokenizer_file()), bpe.tokenizer_file()).count() == 0


# ------------------------------------------------------------------ urls

def test_url_rules_and_addresses(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/en/12?x", "https://example.org", "http://example.org/es/#a", "x://sub.shop.com/de/1",
            "http://shop.com/fr/", "http://notexample.org.net/es/", "http://com/fr/x", "http://a.org/://b/c", "http://ÉA.org/É", "http://h.net/a"]
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(urls)] + [(3, urls[3], None, "x")], "page_id long, url string, html string, host string")
    got = url_filter.filter_urls(pages).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        u = urls[r.page_id] or ""
        m = re.search(r"://([^/?#]*)([^?#]*)", u)
        host, path = (re.sub("[A-Z]", lambda x: x.group().lower(), m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        if best:
            assert r.verdict == best[2]
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_trust_by_matrix(spark):
    rng = random.Random(11)
    hosts = [f"h{i}" for i in range(12)]
    edges = {(a, b): rng.randint(1, 5) for a in hosts for b in hosts if a != b and rng.random() < 0.25}
    seeds = [(h, float(rng.random() < 0.3), float(rng.random() < 0.3)) for h in hosts]
    m = np.zeros((12, 12))
    for (a, b), n in edges.items():
        m[hosts.index(a), hosts.index(b)] = n
    out = lambda x: np.divide(x, x.sum(axis=1, keepdims=True), out=np.zeros_like(x), where=x.sum(axis=1, keepdims=True) > 0)
    good, bad = (np.array([s[i] for s in seeds]) for i in (1, 2))
    good, bad = (x / max(x.sum(), 1) for x in (good, bad))
    t, d = (0.15 * x @ np.linalg.inv(np.eye(12) - 0.85 * y) for x, y in ((good, out(m)), (bad, out(m.T))))
    seeds, edges = (spark.createDataFrame(seeds, "host string, good double, bad double"),
                    spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, links long"))
    for fan in (url_filter.FAN, 2):  # with 2, most hosts' links are dealt to several keys
        got = url_filter.propagate(seeds, edges, tolerance=1e-4, fan=fan).collect()
        assert {r.host for r in got} == {h for h, x, y in zip(hosts, t, d) if x + y > 0}
        for r in got:
            assert abs(r.trust - t[hosts.index(r.host)]) < 1e-4 and abs(r.distrust - d[hosts.index(r.host)]) < 1e-4


def test_distrust_reaches_the_end_of_a_chain(spark):
    """Hosts that lead to a blocked one by up to 40 links are blocked, whatever the distance."""
    link = lambda to: f'<a href="http://{to}/x">'
    pages = [(0, "http://bad.com/de/1", "")] + [(i, f"http://h{i}.net/a", link("bad.com" if i == 1 else f"h{i - 1}.net")) for i in range(1, 41)]
    pages += [(100, "http://good.org/a", link("fine.net")), (101, "http://fine.net/a", None)]
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: "block" for i in range(41)} | {100: "allow", 101: "allow"}


def test_links_pull_hosts_to_their_side(spark):
    pages = [(1, "http://bad.com/de/1", ""), (2, "http://fan.net/a", '<a href="http://bad.com/x">'), (3, "http://good.org/a", "<a href='https://friend.net/'>"),
             (4, "http://friend.net/b", None), (5, "http://other.net/c", '<a href="/c">')]
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_contamination_reads_the_corpus_as_often_for_any_benchmark(spark, tmp_path, monkeypatch):
    """Ten thousand times the windows: the same passes over the documents, and no window comes to the driver."""
    rng = random.Random(12)
    some = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("0123456789") for _ in range(n))
    texts = [some(60) for _ in range(50)]
    frame(spark, texts).write.parquet(str(tmp_path / "docs"))
    docs, passes = spark.read.parquet(str(tmp_path / "docs")), []
    for name in ("corpus_counts", "candidates", "map_docs"):
        real = getattr(decontaminate, name)
        monkeypatch.setattr(decontaminate, name, lambda *a, real=real, name=name, **k: passes.append(name) or real(*a, **k))
    for items in ([(0, texts[0])], [(i, some(60)) for i in range(3000)] + [(-1, "x " * 30 + texts[7])]):
        bench = spark.createDataFrame(items, "item_id long, text string")
        passes.clear()
        got = {r.doc.doc_id: r["items"] for r in decontaminate.contamination(docs, bench).collect() if r.n_hit}
        assert got == ({0: ["0"]} if len(items) == 1 else {7: ["-1"]})
        assert passes == ["corpus_counts", "candidates", "map_docs"]


def test_a_preamble_of_many_items_and_documents(spark):
    """A window that many items and many documents share is joined with the items once for a set of windows."""
    preamble = "read the following passage with care and answer every question that follows it"
    bench = spark.createDataFrame([(i, f"{preamble} number{i} alpha{i}") for i in range(300)], "item_id long, text string")
    texts = [f"{preamble} and more" for _ in range(400)] + [f"{preamble} number7 alpha7"]
    got = decontaminate.contamination(frame(spark, texts), bench).collect()
    assert all(r.n_hit == 13 and len(r["items"]) == 300 for r in got if r.doc.doc_id < 400)
    last = [r for r in got if r.doc.doc_id == 400][0]
    assert last.n_hit == 15 and len(last["items"]) == 300 and [tuple(s) for s in last.spans] == [(0, 15)]


def test_a_conversation_of_many_ranges(spark):
    """A conversation that holds most rows is dealt over ranges; places and digests are those of one pass."""
    rng = random.Random(4)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"say {i} ###{'x' * rng.randrange(9)}") for i in range(900)]
    rows += [(c, i, "user", "hello there") for c in range(2, 40) for i in range(3)] + [(None, i % 2, "assistant", None) for i in range(300)] + [(50, 1, "user", "same")] * 200
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, ids string, range long").repartition(9)
    path = bpe.tokenizer_file()
    made = chat.format_turns(df, path)
    got = made.collect()
    ranges = {(r.conv_id, r.token_start) for r in got}
    assert len(got) == len(ranges) == len(rows)
    for conv in (1, 2, None, 50):
        own = sorted((r for r in got if r.conv_id == conv), key=lambda r: r.token_start)
        assert [r.token_start for r in own] == np.cumsum([0, *[len(r.ids) for r in own]])[:-1].tolist()
        assert [(r.turn, r.role, r.text) for r in own] == sorted((t, r, x or "") for c, t, r, x in rows if c == conv)
    back = {r.conv_id: r for r in chat.read_back(made, path).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((t, r, x or "") for c, t, r, x in rows if c == conv)
        said = "".join(x for _, r, x in own if r == "assistant")
        assert back[conv].n_turns == len(own) and back[conv].loss_chars == len(said)
        assert back[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert back[conv].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_chat_and_counts_of_odd_tables(spark):
    """A turn of over 1 MB, an empty table, clashing names."""
    path = bpe.tokenizer_file()
    text = "long words and ### marks " * 50000
    df = spark.createDataFrame([("c", 1, "assistant", text, 1)], "conv_id string, turn int, role string, text string, mask int")
    back = chat.read_back(chat.format_turns(df, path), path).collect()
    assert [(r.n_turns, r.loss_chars, r.loss_sha256) for r in back] == [(1, len(text), hashlib.sha256(text.encode()).hexdigest())]
    assert chat.read_back(chat.format_turns(df.limit(0), path), path).count() == 0
    odd = spark.createDataFrame([(1, "some words", 5, "d")], "doc_id long, text string, n_tokens int, doc string")
    counted = token_counts.token_counts(odd, token_counts.model_file())
    assert counted.first().n_tokens > 0 and counted.first().doc.n_tokens == 5 and token_counts.token_counts(odd.limit(0), token_counts.model_file()).count() == 0
