"""Edge cases and brute-force comparisons of the ten operators on small tables."""

import hashlib
import math
import random
import re
import time
from types import SimpleNamespace

import numpy as np
import pytest
import zstandard

from lociflow.llm import common, decontam, doubling, html_text, jaccard, langid, mixing, quality, sharding, suffix, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, shard string, row string, kind string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa the of and to".split()


def rows(seed=1, n=60):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(rng.randrange(4, 80))) for _ in range(n)]
    texts += [None, "", " \n\t ", "one", texts[0], texts[0], texts[1] + " more", texts[2].upper(), "long " * 3000 + texts[3]]
    out = [(i, t, [None, "en", "fr"][i % 3], [None, "src0", "src1", "web"][i % 4], 1, "x", "y", "z", "w", "v") for i, t in enumerate(texts)]
    out.append(out[5])  # a repeated row
    out += [(None, "null id text with some words in it to read", *[None] * 8), (None, "another text without an id", *[None] * 8)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_shared_dir_needs_a_shared_folder():
    session = lambda master, named: SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=SimpleNamespace(master=master))
    assert common.shared_dir(session("spark://somewhere:7077", "hdfs://store/tables/")) == "hdfs://store/tables"
    assert common.shared_dir(session("local[2]", None)).startswith("file://")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(session("spark://somewhere:7077", None))


def test_sharding(docs, empty):
    for part_bytes in (sharding.PART_BYTES, 500):  # one part per shard, and many
        got = [r.asDict() for r in sharding.histogram_shards(docs, 5, part_bytes=part_bytes).collect()]
        assert len(got) == len(rows()) and set(docs.columns) <= set(got[0])
        total = sum(r["size"] for r in got)
        keyed = sorted(got, key=lambda r: (int(hashlib.md5((r["text"] or "").encode()).hexdigest()[:15], 16), -1 if r["doc_id"] is None else r["doc_id"]))
        below, groups = 0, {}
        for r in keyed:
            k = (r["doc_id"], r["text"])
            groups.setdefault(k, below)
            assert r["shard"] == groups[k] * 5 // total
            assert r["size"] == len((r["text"] or "").encode()) + 8 and r["grown_shard"] is None
            below += r["size"]
        for s in range(5):
            slots = sorted(r["slot"] for r in got if r["shard"] == s)
            assert slots == list(range(len(slots)))
    assert sharding.histogram_shards(empty, 5).count() == 0
    assert sharding.histogram_shards(docs, 3, tolerance=0.5).count() == len(rows())


def test_sharding_groups_of_equal_texts(spark):
    """A group stays together unless a splitter falls inside it; a hot group is spread, and its slots stay gapless."""
    frame = spark.createDataFrame([(i, "hot text " * 5) for i in range(400)] + [(1000 + i, f"text number {i % 150}") for i in range(300)], "doc_id long, text string")
    got = sharding.histogram_shards(frame, 6, part_bytes=600).collect()
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(6)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in got)
    split = {r.text for r in got if len({x.shard for x in got if x.text == r.text}) > 1}
    assert "hot text " * 5 in split and len(split) <= 6
    for s in range(6):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_quality(docs, empty):
    got = {(r.doc_id, r.text): r for r in quality.with_quality(docs).collect()}
    for (_, text), r in got.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        counts = {}
        for i in range(len(w) - 4):
            counts.setdefault(tuple(w[i : i + 5]), []).append(i)
        hit = {k for v in counts.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(hit), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 10 or 100 * len(hit) > 20 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality.with_quality(empty).count() == 0


def test_tokens(docs, empty):
    table = tokens.context_table(tokens.length_histogram(tokens.encoded_lengths(docs)))
    encode = tokens.encoder(tokens.TOKENIZER_DIR, tokens.VOCABULARY).encode_ordinary
    lengths = [len(encode(r[1])) if r[1] else 0 for r in rows()]
    for r in table.collect():
        assert r.n_docs == lengths.count(r.n_tokens)
        assert r.docs_at_least == sum(x >= r.n_tokens for x in lengths)
        assert r.tokens_within_limit == sum(min(x, r.n_tokens) for x in lengths)
    for r in tokens.answer_limits(table, [0, 7, 50, 10**6]).collect():
        assert r.tokens_within_limit == sum(min(x, r.context_limit) for x in lengths)
        assert r.docs_over == sum(x > r.context_limit for x in lengths)
    for r in tokens.quantile_lengths(table, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == sorted(lengths)[math.ceil(round(r.q * len(lengths), 9)) - 1]
    nothing = tokens.context_table(tokens.length_histogram(tokens.encoded_lengths(empty)))
    assert nothing.count() == 0 and tokens.answer_limits(nothing, [5]).first().tokens_within_limit == 0


def test_mixing(docs, empty):
    got = mixing.mix_sources(docs, budget_percent=150, max_epochs=2).collect()
    words = sum(len((r[1] or "").split()) for r in rows())
    assert 0 < sum(r.n_tokens for r in got) <= words * 150 // 100
    by_leaf = {}
    for r in got:
        by_leaf.setdefault((r.domain, r.lang, r.source), []).append(r)
    for leaf in by_leaf.values():
        assert sum(r.n_tokens for r in leaf) <= leaf[0].leaf_budget
    narrow = mixing.mix_selection(docs, budget_percent=150, max_epochs=2).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.epoch, r.n_tokens, r.leaf_budget, r.domain)
    assert sorted(map(key, narrow)) == sorted(map(key, got))
    everything = mixing.mix_sources(docs, budget_percent=100, max_epochs=1).collect()
    assert len(everything) == len(rows())
    assert mixing.mix_sources(empty).count() == 0


def test_mixing_repeated_rows_in_the_last_bucket(spark):
    frame = spark.createDataFrame([(1, "a b c", "en", "src1")] * 10, "doc_id long, text string, lang string, source string")
    for percent, want in ((50, 5), (100, 10), (130, 13)):
        assert mixing.mix_sources(frame, budget_percent=percent, max_epochs=2).count() == mixing.mix_selection(frame, budget_percent=percent, max_epochs=2).count() == want


def slow_language(text, dictionaries):
    """Sizes of every chunk under every dictionary, with encoders of their own."""
    clean = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip()
    if not any(c.isalpha() for c in clean):
        return "und", True
    sizes = {}
    for name, content in dictionaries.items():
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        total = 0
        for k in range(0, len(clean), langid.CHUNK):
            coder = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False)
            total += len(coder.compress(clean[k : k + langid.CHUNK].encode()))
        sizes[name] = total
    order = sorted(sizes, key=lambda n: (sizes[n], n))
    return order[0], len(order) > 1 and (sizes[order[1]] - sizes[order[0]]) / sizes[order[1]] < langid.MIN_MARGIN


def test_language_id(spark, empty):
    en, fr = "the house of the king and the people with them ", "la maison du roi et les gens avec eux dans "
    train = spark.createDataFrame([(i, (en if i % 2 else fr) * 8, "en" if i % 2 else "fr") for i in range(20)] + [(99, None, "en"), (98, en, None)], "doc_id long, text string, lang string")
    model = langid.fit_dictionaries(train)
    assert sorted(model) == ["en", "fr"]
    probes = [(1, en * 2), (2, fr * 2), (3, None), (4, ""), (5, "12 34 !!"), (6, "x" * 200_000), (7, en + fr), (8, "king"), (None, "roi"), (8, "king")]
    check = spark.createDataFrame([(i, t, "q") for i, t in probes], "doc_id long, text string, score string")
    found = langid.identify(check, model).collect()
    got = {r.doc_id: r for r in found}
    assert (got[1].lang_pred, got[2].lang_pred) == ("en", "fr")
    assert all(got[i].lang_pred == "und" and got[i].rejected for i in (3, 4, 5))
    assert all(0 <= r.score <= 1 for r in found) and len(found) == len(probes)
    for r in found:
        assert (r.lang_pred, r.rejected) == slow_language(r.text, model)
    same = {"aa": model["en"], "bb": model["en"]}  # a tie goes to the first name and is rejected
    assert (langid._Classifier(same)(en)[0], langid._Classifier(same)(en)[2]) == ("aa", True)
    assert langid.fit_dictionaries(empty) == {} and langid.identify(check, {}).where("lang_pred = 'und'").count() == len(probes)
    assert langid.identify(empty, model).count() == 0


def shingle_set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def brute_components(texts, words, percent):
    sets = {i: shingle_set(t, words) for i, t in texts.items()}
    links = {i: [j for j in sets if j != i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])] for i in sets}
    label = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for i in sets:
            least = min([label[i], *(label[j] for j in links[i])])
            if least < label[i]:
                label[i], changed = least, True
    return sets, label, links


@pytest.mark.parametrize(("words", "percent", "small", "block"), [(4, 85, 48, 512), (2, 60, 48, 512), (3, 70, 2, 7)])
def test_jaccard(spark, monkeypatch, words, percent, small, block):
    monkeypatch.setattr(jaccard, "SMALL", small)  # 2: all groups go through blocks, and blocks of 7 rows meet each other
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    monkeypatch.setattr(jaccard, "STREAM", 5)
    rng = random.Random(5)
    base = [[rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(60)] for _ in range(3)]
    texts = {}
    for i in range(70):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(30)}"
        texts[i + 10] = " ".join(w)
    texts |= {1: None, 2: "", 3: "A b", 4: "a B", 5: "solo"}
    frame = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, row string").repartition(3)
    got = jaccard.jaccard_components(frame, words, percent).collect()
    sets, label, links = brute_components(texts, words, percent)
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_shingles, r.component_id, r.n_links) == (len(sets[r.doc_id]), label[r.doc_id], len(links[r.doc_id]))
    assert jaccard.jaccard_components(frame.where("doc_id < 0"), words, percent).count() == 0


def test_jaccard_null_and_repeated_ids(spark):
    rng = random.Random(6)
    text = [" ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(50)) for _ in range(4)]
    data = [(None, text[0]), (7, text[0] + " more"), (7, text[1]), (7, text[1]), (9, text[1] + " more"), (None, text[2]), (None, text[2] + " more"), (3, text[3]), (None, None)]
    got = jaccard.jaccard_components(spark.createDataFrame(data, "doc_id long, text string"), 5, 80).collect()
    assert len(got) == len(data)
    assert sorted((r.doc_id or 0, r.n_shingles > 0, r.component_id or 0, r.n_links) for r in got) == sorted(
        [(0, True, 7, 1), (7, True, 7, 1), (7, True, 7, 2), (7, True, 7, 2), (9, True, 7, 2), (0, True, 0, 1), (0, True, 0, 1), (3, True, 3, 0), (0, False, 0, 0)]
    )
    assert len({r.component for r in got}) == 5


def test_suffix_filter_is_a_bound():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 120, rng.integers(0, 60))).astype(np.uint64) for _ in range(2))
        apart = len(np.setxor1d(x, y))
        for most in (0, 3, 10, 200):
            bound = jaccard.suffix_bound(x, y, most)
            assert bound <= apart or (bound > most and apart > most)
        for percent in (50, 80, 85):
            both = len(np.intersect1d(x, y))
            assert jaccard.similar(x, y, percent) == (100 * both >= percent * (len(x) + len(y) - both))


def brute_suffix(texts):
    seen, want = set(), {}
    for i in sorted({i for i, _ in texts}):
        new = set()
        for t in {t for k, t in texts if k == i}:
            b = (t or "").encode()
            mark, own = bytearray(len(b)), [b[k : k + 50] for k in range(len(b) - 49)]
            for k, s in enumerate(own):
                if s in seen:
                    mark[k : k + 50] = b"\1" * 50
            new.update(own)
            spans = sum(1 for k in range(len(b)) if mark[k] and (not k or not mark[k - 1]))
            want[(i, t)] = (len(b), sum(mark), spans, hashlib.sha256(bytes(c for c, m in zip(b, mark) if not m)).hexdigest())
        seen |= new
    return want


def suffix_texts():
    rng = random.Random(3)
    passage = ["".join(rng.choice("abcd é") for _ in range(rng.randrange(40, 160))) for _ in range(6)]
    passage.append("a phrase of thirty bytes, hot!")
    texts = [(i, "".join(rng.choice([rng.choice(passage), "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(5, 90)))]) for _ in range(5))) for i in range(40)]
    return texts + [(50, None), (51, ""), (52, "x" * 400), (53, "x" * 120), (54, texts[3][1]), (55, "y" * 49), (56, "y" * 49)]


@pytest.mark.parametrize(("hot", "crowd"), [(64, 4096), (2, 4096), (64, 1)])
def test_suffix(spark, monkeypatch, hot, crowd):
    monkeypatch.setattr(suffix, "HOT_DOCS", hot)  # 2: shared ranks are dealt by strings from the start
    monkeypatch.setattr(suffix, "CROWD", crowd)  # 1: open anchors are dealt by strings
    texts = suffix_texts()
    frame = spark.createDataFrame([*texts, texts[7]], "doc_id long, text string").repartition(3)
    got = suffix.suffix_digest(frame).collect()
    want = brute_suffix(texts)
    assert len(got) == len(texts) + 1
    by_id = {i: want[(i, t)] for i, t in texts}
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == by_id[r.doc_id]
    assert suffix.suffix_digest(frame.where("doc_id < 0")).count() == 0


def test_suffix_several_texts_under_one_id(spark):
    p = "a passage that is long enough to be found again by fifty bytes, surely. "
    texts = [(1, p + "abc"), (2, p + "zzz"), (2, "q" * len(p + "zzz")), (2, p + "yyy"), (None, p), (None, "other words " + p), (3, "q" * 60)]
    got = suffix.remove_repeats(spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, row string")).collect()
    want = brute_suffix([(-1 if i is None else i, t) for i, t in texts])
    assert len(got) == len(texts)
    for r in got:
        n, removed, spans, sha = want[(-1 if r.doc_id is None else r.doc_id, r.text.decode())]
        assert (len(r.text), len(r.text) - len(r.kept), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) == (n, removed, spans, sha)


def test_prefix_doubling_agrees(spark):
    texts = suffix_texts()
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = {}
    for r in doubling.repeated_positions(frame).collect():
        found.setdefault(r.doc_id, []).append(r.pos)
    for r in suffix.remove_repeats(frame).collect():
        covered = {k for p in found.get(r.doc_id, []) for k in range(p, p + 50)}
        assert covered == {k for s in r.spans for k in range(s.start, s.end)}


def test_html(spark, empty):
    page = '<html><head><title>T</title></head><body><nav><a>Home page here</a></nav><div class="ad">Buy now cheap</div><article><h1>Head &amp; line</h1><p>First  words\nof text.<p><b>Second</b> one &eacute;.<aside>side</aside><p>Third.</article><div id="comments"><p>nice post indeed</p></div><footer>foot</footer>'
    frame = spark.createDataFrame([(1, "u", page, "t"), (2, "u", None, "t"), (3, "u", "", "t"), (4, "u", "<p>" + "word " * 50_000, "t"), (5, "u", "<!-- open <p>a b c", "t"), (6, None, page, "t"), (None, None, page, "t")], "page_id long, url string, html string, text string")
    weights = html_text.fit_weights(frame)
    found = html_text.extract(frame, weights).collect()
    got = {r.page_id: r for r in found}
    want = "Head & line\nFirst words of text.\nSecond one é.\nThird."
    assert got[1].text == got[6].text == got[None].text == want and got[1].n_chars == len(want)
    assert got[2].text == got[3].text == got[5].text == ""
    assert got[4].text == ("word " * 50_000).strip()
    assert html_text.fit_weights(frame.where("page_id = 2")) == {}
    assert html_text.extract(frame.where("page_id = 0"), weights).count() == 0


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<p>tail <b class="x', "tail"),
        ('<section id="search-methods"><p>kept words here</p></section>', "kept words here"),
        ('<p class="ad-hoc">ad hoc words stay</p>', "ad hoc words stay"),
        ("<article><header><h1>Own head</h1></header><p>text of it</p></article>", "Own head\ntext of it"),
        ("<p>the sum <math><mi>x</mi></math> is</p>", "the sum x is"),
        ('<p>before <svg/> after <iframe src="x"/> end</p>', "before after end"),
        ('<div class="sidebar"><article><p>kept in main</p></article></div>', "kept in main"),
        ("<p>a < b and c</p>", "a < b and c"),
        ("<p title=it's>quote</p><p>next</p>", "quote\nnext"),
        ("<p>text<script>var a = '</p>';</script> goes on</p>", "text goes on"),
        ("<nav><ul><li><a>Home</a></ul></nav><div>" + "word " * 20 + "</div><footer>foot</footer>", ("word " * 20).strip()),
    ],
)
def test_html_rules(page, want):
    assert html_text.main_text(page, {}) == want


def test_html_is_linear():
    for piece in ('<a "', "<div>", '<a b="', "<li>", "</p", "<!--", "<title>"):
        began = time.perf_counter()
        html_text.main_text(piece * 8000, {})
        assert time.perf_counter() - began < 1.0, piece


def test_html_learns_names_and_works_without_main_elements(spark):
    def page(i, article):
        body = f"<h1>Title {i}</h1><p>{'real words of the text ' * 4}</p><div class='teaserbox'><p>{'see our other offers today ' * 4}</p></div><p>{'and the end of it ' * 3}</p>"
        side = f"<div class='teaserbox'><p>{'see our other offers today ' * 6}</p></div>"
        return f"<html><body>{side}<article>{body.replace('teaserbox', 'quote')}</article>{side}</body></html>" if article else f"<html><body>{side}{body}{side}</body></html>"

    frame = spark.createDataFrame([(i, page(i, True)) for i in range(40)], "page_id long, html string")
    weights = html_text.fit_weights(frame)
    plain = page(99, False)
    assert "offers" in html_text.main_text(plain, {}) and "offers" not in html_text.main_text(plain, weights)
    assert html_text.main_text(plain, weights).startswith("Title 99\nreal words")


def brute_decontamination(texts, bench, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, t in bench:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + window]), set()).add(item or "")
    out = []
    for i, t in texts:
        w, hit, items = words(t), set(), set()
        for piece, names in windows.items():
            for k in range(len(w) - len(piece) + 1):
                if tuple(w[k : k + len(piece)]) == piece:
                    hit |= set(range(k, k + len(piece)))
                    items |= names
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()))
    return sorted(out, key=str)


def test_decontamination(spark, monkeypatch):
    bench = [("i1", "one two three four five six seven eight nine ten eleven twelve"), ("i2", "Short Item"), ("i3", None), ("i4", "..."), ("i2", "Short Item"), ("i5", "aa bb cc dd ee ff gg hh ii jj"), (None, "a nameless item")]
    texts = [(1, "x one two three four five six seven eight nine ten eleven y short item"), (2, None), (3, ""), (4, "ONE-two,three four five six seven eight nine TEN"), (5, "aa bb cc zz dd ee ff gg hh ii jj"), (6, "short, item short item"), (6, "short, item short item"), (6, "other text"), (None, "a nameless item")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, segment string")
    benchmark = spark.createDataFrame(bench, "item_id string, text string")
    want = brute_decontamination(texts, bench)
    for postings, group in ((decontam.SEGMENT_POSTINGS, decontam.WINDOW_BLOCK), (4, 2)):  # one segment and group, and several
        monkeypatch.setattr(decontam, "SEGMENT_POSTINGS", postings)
        monkeypatch.setattr(decontam, "WINDOW_BLOCK", group)
        got = decontam.contamination_digest(decontam.contamination(frame, benchmark)).collect()
        assert sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got], key=str) == want
        assert {r.doc_id for r in got if r.n_near} == {5} and all(r.contaminated == (r.n_hit > 0) for r in got)
    none = decontam.contamination_digest(decontam.contamination(frame, benchmark.where("false"))).collect()
    assert len(none) == len(texts) and not any(r.contaminated for r in none)
    assert decontam.contamination(frame.where("false"), benchmark).count() == 0


def test_decontamination_on_random_texts(spark):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(6)]
    texts = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(60)]
    bench = [(f"b{k}", " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 7)))) for k in range(25)]
    hits = decontam.contamination(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), spark.createDataFrame(bench, "item_id string, text string"), window=4)
    got = decontam.contamination_digest(hits).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got], key=str) == brute_decontamination(texts, bench, 4)


def test_toxicity_kernel_by_enumeration():
    """Folded weights give the kernel that enumerating all gapped triples gives."""

    def phi(letters):
        out = {}
        for i in range(len(letters)):
            for j in range(i + 1, len(letters)):
                for k in range(j + 1, len(letters)):
                    if k - i < toxicity.SPAN:
                        key = (letters[i], letters[j], letters[k])
                        out.setdefault(key, []).append(toxicity.DECAY ** (k - i + 1))
        return out

    def unit(letters):
        f = phi(letters)
        norm = math.sqrt(max(sum(w * w for v in f.values() for w in v), toxicity.DECAY**6))
        return {u: sum(v) / norm for u, v in f.items()}

    rng = random.Random(3)
    for _ in range(20):
        target = [rng.randrange(1, 27) for _ in range(rng.randrange(3, 9))]
        weights = np.zeros(toxicity.CLASSES**3, np.float32)
        for (a, b, c), v in unit(target).items():
            weights[(a * toxicity.CLASSES + b) * toxicity.CLASSES + c] = v
        words = ["".join(chr(96 + rng.randrange(1, 27)) if rng.random() < 0.4 else chr(96 + rng.choice(target)) for _ in range(rng.randrange(2, 8))) for _ in range(6)]
        f = toxicity.fold([" ".join(words[:4]) + ". " + " ".join(words[4:])])
        one, two = toxicity.unit_scores(f, weights, 0.0)
        codes = [[ord(x) - 96 for x in w] for w in words]
        kernel = lambda s: sum(v * unit(target).get(u, 0.0) for u, v in unit(s).items())
        assert np.allclose(one, [kernel(c) for c in codes], atol=1e-5)
        for k in range(6):
            pair = codes[k] + codes[k + 1] if k < 5 else []
            if k in (3, 5) or len(pair) < toxicity.MIN_JOINED:  # a sentence ends there
                assert two[k] == -np.inf
            else:
                assert abs(two[k] - kernel(pair)) < 1e-5


def test_toxicity_margins_of_best_units():
    rng = np.random.default_rng(3)
    weights = rng.normal(size=toxicity.CLASSES**3).astype(np.float32)
    words = ["abcde", "fghij", "klmno", "pqrst", "uvwxy", "edcba"]
    texts = ["", "...", "abcde", "abcde abcde abcde.", *(" ".join(rng.choice(words, n)) + "." for n in (2, 5, 9, 30))]
    got = toxicity.top_margins(texts, weights, 0.1)
    for text, row in zip(texts, got, strict=True):
        f = toxicity.fold([text])
        score = list(np.max(toxicity.unit_scores(f, weights, 0.1), axis=0)) if len(f.starts) else []
        best: dict = {}
        for i, (word, s) in enumerate(zip(text.strip(".").split(), score, strict=False)):
            if (i == 0 or s > score[i - 1]) and (i + 1 == len(score) or s >= score[i + 1]):  # no overlap with a better one
                best[word] = max(s, best.get(word, s))
        want = sorted(best.values(), reverse=True) or [toxicity._LOW]
        want += want[-1:] * toxicity.TOP_UNITS
        assert np.allclose(row, want[: toxicity.TOP_UNITS])
    assert np.allclose(toxicity.document_margins(texts, weights, 0.1), got[:, 0])
    assert np.allclose(toxicity.document_margins(texts, weights, 0.1, 0.5), (got[:, 0] + got[:, 1:].mean(axis=1)) / 2)


def test_toxicity(spark, empty):
    rng = random.Random(2)
    plain = lambda: " ".join(rng.choice(WORDS) + rng.choice(["", "an", "er", "ly"]) for _ in range(30)) + ". "
    insults = ["you blockhead ", "what a nitwit ", "half wit there "]
    texts = [(i, plain() + (insults[i // 4 % 3] + plain() if i % 4 == 0 else "you what a " + plain())) for i in range(320)]
    texts.append((5, "nitwit " + plain()))  # a clean label that is wrong, beside the longer right text
    texts[9] = (9, "nitwit " + texts[9][1])  # another
    frame = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)] + [(8, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels)
    probe = spark.createDataFrame([(1, plain() + "nitwit"), (2, plain() + "n.i.t.w.i.t"), (3, plain() + "bloockhead"), (4, plain()), (5, None), (6, ""), (7, plain() * 400), (8, plain() + "nit wit"), (9, plain() + "halfwit")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(probe, model).collect()}
    assert [got[i].predicted for i in range(1, 10)] == [1, 1, 1, 0, 0, 0, 0, 1, 1]
    assert all(0 <= r.score <= 1 for r in got.values())
    held = toxicity.score(frame.where("doc_id >= 240"), model).collect()
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert not any(r.predicted for r in toxicity.score(probe, toxicity.fit(empty, labels)).collect())
    assert toxicity.score(empty, model).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    rng = random.Random(12)
    word = lambda: rng.choice("abcdefghijkl") * 2
    bench = [(f"i{k}", " ".join(word() for _ in range(rng.choice([3, 10, 14])))) for k in range(12)]
    docs = [(k, " ".join(word() for _ in range(20)) + " " + rng.choice(bench)[1] + " " + word()) for k in range(40)] + [(7, None), (None, bench[0][1]), (None, bench[0][1])]
    frame, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id string, text string")
    digest = lambda: sorted(map(tuple, decontam.contamination_digest(decontam.contamination(frame, items)).collect()), key=str)
    whole = digest()
    monkeypatch.setattr(decontam, "WINDOW_BLOCK", 5)
    assert digest() == whole and len(whole) == len(docs)


def test_a_long_text_does_not_fill_a_dictionary(spark):
    rows = [(k, "alpha beta gamma", "en") for k in range(5)] + [(9, "omega " * 40_000, "en")]
    content = langid.fit_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))["en"]
    assert b"alpha beta" in content and content.count(b"omega") < 2000 and len(content) <= langid.DICT_BYTES


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(6)
    for n in (0, 1, 300, 500, 1700, 7000):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: n // 2], rng.integers(0, 2**63, n // 3 + 1).astype(np.uint64)]))
        a, b = jaccard.sketch_of(x), jaccard.sketch_of(y)
        size = min(len(a), len(b))
        for words in (size, 8):
            apart = int(np.bitwise_count((jaccard.folded(a, words) ^ jaccard.folded(b, words)).view(np.uint64)).sum())
            assert apart <= len(np.setxor1d(x, y))
    small = jaccard.sketch_of(np.arange(7000, dtype=np.uint64))
    assert len(small) == 8 * 64 and np.array_equal(jaccard.folded(small, 512), small)
