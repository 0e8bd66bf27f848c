"""The training-data operators against brute force, on small tables and planted cases."""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import difference, views

import corpus_pipeline
from caseflow.llm import (bitplane, decontaminate, jaccard_join, knn_quality, packing, pca_dedup, pii_boost, queries,
                          site_style, suffix_tree, toxicity)
from caseflow.llm.common import blank_words, ready
from caseflow.llm.components import components
from caseflow.session import shared_dir

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "one two"), (4, "x" * 50_000), (5, "a b c d e f g h i j k l"), (6, "a b c d e f g h i j k l"),
       (6, "a b c d e f g h i j k l"), (None, "null id text here now")]


@pytest.fixture(scope="module")
def llm(spark):
    return ready(spark)


def odd(llm, rows=ODD):
    """Documents with odd rows and columns whose names clash with results."""
    return llm.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), 0.5, "z") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score double, node string")


def labels(llm, rows=()):
    return llm.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(llm, name):
    assert difference(queries.QUERIES[name](llm, SF), views(SF), queries.ORACLES[name]) is None


def test_decontaminate_odd_rows(llm):
    bench = llm.createDataFrame([(7, "C d, E"), (8, None), (9, " . "), (8, "k l")], "item_id long, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items): r for r in decontaminate.report(odd(llm), bench).collect()}
    assert got[5, 12, 5, 2].items_sha256 == hashlib.sha256(b"7,8").hexdigest()
    assert sum(k[0] == 6 for k in got) == 1 and got[1, 0, 0, 0].contaminated is False
    assert decontaminate.report(odd(llm, []), bench).count() == 0
    kept = decontaminate.cleaned(odd(llm), bench)
    assert kept.columns == odd(llm).columns and kept.filter("doc_id = 5").first().text.split() == list("ab") + list("fghij")


def test_decontaminate_in_blocks_is_the_same(llm, monkeypatch):
    docs, bench = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontaminate.report(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 500)
    assert sorted(map(tuple, decontaminate.report(docs, bench).collect())) == whole


def test_jaccard_signatures_never_miss():
    """Every pair at the similarity shares a signature, for all sizes."""
    random, bands = np.random.default_rng(1), jaccard_join.Bands()
    for _ in range(1_500):
        n = int(random.integers(1, 400))
        a = np.unique(random.integers(0, 1 << 62, n, dtype=np.uint64))
        drop = int(random.integers(0, len(a) // 5 + 1))
        b = a[random.permutation(len(a))[:len(a) - drop]]
        b = np.unique(np.r_[b, random.integers(0, 1 << 62, int(random.integers(0, drop + 2)), dtype=np.uint64)])
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert set(jaccard_join.signatures(a, bands)) & set(jaccard_join.signatures(b, bands))


def _brute_components(texts: dict[int, str | None]) -> dict[int, int]:
    sets = {}
    for i, t in texts.items():
        w = blank_words(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    group = {i: i for i in texts}
    for _ in texts:
        changed = False
        for i in texts:
            for j in texts:
                k = len(sets[i] & sets[j])
                if sets[i] and 100 * k >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
        if not changed:
            break
    return group


def test_jaccard_join_of_chains_and_odd_rows(llm):
    random = np.random.default_rng(2)
    base = [f"w{k}" for k in random.integers(0, 500, 80)]
    texts = {10: " ".join(base)}
    for i in range(11, 40):  # each a small edit of the one before, so ends of the chain differ
        base = list(base)
        base[int(random.integers(0, 80))] = f"v{i}"
        texts[i] = " ".join(base)
    texts |= {50: None, 51: "", 52: " \n", 53: "A b", 54: "a B", 55: "a b c d e", 56: "a b c d e a b c d e"}
    docs = odd(llm, [*texts.items(), (10, texts[10])])
    got = jaccard_join.joined(docs).collect()
    want = _brute_components(texts)
    assert len(got) == len(texts) + 1 and {r.doc_id: r.component_id for r in got} == want
    kept = jaccard_join.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert jaccard_join.joined(odd(llm, [])).count() == 0


def test_components(llm):
    edges = llm.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (5, 5), (101, 100), (None, 3)], "u long, v long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_components_across_runs_of_edges(llm):
    """Four edges a run, so that rounds must join what the runs leave apart."""
    random = np.random.default_rng(3)
    pairs = [(k, k + 7) for k in range(150)] + [tuple(map(int, p)) for p in random.integers(1000, 1200, (90, 2))]
    before, name = llm.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    llm.conf.set(name, "4")
    try:
        got = dict(map(tuple, components(llm.createDataFrame(pairs, "u long, v long"), chunk=4).collect()))
    finally:
        llm.conf.set(name, before)
    want = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in want:
        for u, v in pairs:
            if u != v:
                want[u] = want[v] = min(want[u], want[v])
    assert got == want


def test_suffix_tree_base_and_distribution(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in suffix_tree.scored(docs).collect()}
    count, texts = Counter(), {r.doc_id: r.text for r in docs.collect()}
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update([*blank_words(t), None])
    total, scale = sum(count.values()), sum(count.values()) + 0.5 * (len(count) + 1)
    for i, t in texts.items():
        words, row = [*blank_words(t), None], rows[i]
        base = sum(np.log10((count[w] + 0.5) / scale) for w in words)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(w in count for w in words), total)
        assert row.base_score == pytest.approx(base, rel=1e-9) and row.held_out == (zlib.crc32(str(i).encode()) % 5 == 1)


def test_suffix_tree_states_are_distributions(llm):
    random = np.random.default_rng(4)
    texts = [" ".join(["the", "cat", "sat"] if random.random() < .5 else ["a", "cat", random.choice(list("xyz"))])
             for _ in range(400)]
    train = llm.createDataFrame(
        [(i, i, False, t) for i, t in enumerate(texts)], "row long, doc_id long, held_out boolean, text string")
    tree, _, _ = suffix_tree.learn(train)
    assert any((~np.isnan(r)).any() for r in tree.log_rest)
    words = sorted({w for t in texts for w in blank_words(t)})
    for context in ("the cat", "a cat", "cat", "the"):
        sum_of = 0.0
        for word in [*words, "unseen", None]:
            text = context if word is None else f"{context} {word.decode() if isinstance(word, bytes) else word}"
            ((_, codes, tokens, _),) = list(suffix_tree.coded([text]))
            first = tree.first(codes, tokens)
            base, added = tree.score(first, tokens == 0)
            at = len(context.split())
            rare = 0.0 if first[at] >= 0 else np.log10(0.5 / tree.scale)
            sum_of += 10 ** (base[at] + added[at] + rare)
        assert sum_of == pytest.approx(1.0, abs=1e-9)


def test_suffix_tree_keeps_rare_sequences(llm, monkeypatch):
    """Whatever is broadcast, the sequences that occur ``MIN_COUNT`` times decide the scores."""
    random = np.random.default_rng(5)
    texts = [f"red {random.choice(list('xyz'))}{k % 40} pairs with blue{k % 40} then {random.choice(list('uvw'))} ends" for k in range(900)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(suffix_tree, "P_MIN", 1e-9)
    want = {r.doc_id: r for r in suffix_tree.scored(docs).collect()}
    assert sum(abs(r.score - r.base_score) > 0.1 for r in want.values()) > 800
    for share in (0.004, 0.9):
        monkeypatch.setattr(suffix_tree, "P_MIN", share)
        for r in suffix_tree.scored(docs).collect():
            assert (r.n_tokens, r.n_known) == (want[r.doc_id].n_tokens, want[r.doc_id].n_known)
            assert r.score == pytest.approx(want[r.doc_id].score, rel=1e-9)


def test_suffix_tree_odd_rows(llm):
    got = suffix_tree.scored(odd(llm)).collect()
    assert len(got) == len(ODD) and {r.n_tokens for r in got if r.doc_id in (1, 2)} == {1}
    assert suffix_tree.scored(odd(llm, [])).count() == 0


def test_suffix_tree_short_blocks(llm):
    """Fewer tokens than the longest sequences have words."""
    docs = llm.createDataFrame([(1, None)], "doc_id long, text string").coalesce(1)
    (row,) = suffix_tree.scored(docs).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (1, 1, 1) and row.score == pytest.approx(row.base_score)


def test_suffix_tree_blocks_and_buckets_are_the_same(llm, monkeypatch):
    """Blocks ask for codes in one row per bucket, however many sequences their documents hold."""
    random = np.random.default_rng(6)
    texts = [" ".join(f"w{k} x{k}" for k in random.zipf(1.3, 30) % 500) for _ in range(600)] + ["", None]
    docs = llm.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(2)
    monkeypatch.setattr(suffix_tree, "P_MIN", 0.5)
    want = sorted(map(tuple, suffix_tree.scored(docs).collect()))
    monkeypatch.setattr(suffix_tree, "BLOCK_CHARS", 3000)
    monkeypatch.setattr(suffix_tree, "LEAST_BUCKETS", 3)
    got = sorted(map(tuple, suffix_tree.scored(docs).collect()))
    assert [r[:5] for r in got] == [r[:5] for r in want] and any(r[6] != r[5] for r in want)
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)
    train = docs.selectExpr("doc_id", "false AS held_out", "text")
    tree, (_, others, tables, buckets), encoded = suffix_tree.learn(train)
    share = llm.sparkContext.broadcast
    asked = encoded.select("block", "codes", "tokens").mapInArrow(
        suffix_tree._asked(share(tree.keys[0]), tables, share(suffix_tree.bit_table(others, "code", suffix_tree.BITS)), buckets),
        "bucket int, block long, codes binary").collect()
    assert encoded.count() < 70 and len(asked) <= 2 * buckets * encoded.count()
    assert sum(len(suffix_tree._unpacked_codes(r.codes)) for r in asked) > 3 * len(asked)


def test_suffix_tree_ends_undo_joined():
    codes = np.random.default_rng(7).integers(-1 << 63, 1 << 63, 1000)
    joined = suffix_tree._joined(codes)
    assert (suffix_tree._ends(joined, codes[:-1]) == codes[1:]).all()
    ordered = np.sort(codes.view(np.uint64)).view(np.int64)
    assert (suffix_tree._unpacked_codes(suffix_tree._packed_codes(ordered)) == ordered).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_bitplane_round_trip(llm, kind):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    hard = [(20, "It's  two\n\n spaces , don't   stop.\t x "), (21, "naïve²³ ½ ÀÉ|x, 12,5% <|endoftext|> \x00 a"),
            (22, "word.,!! word's x.y  "), (23, " lead \n tail ")]
    docs = odd(llm, [*ODD, *hard])
    path = shared_dir(llm)
    bitplane.write_ids(docs, path, public.path("byte_bpe_50k.json"), kind=kind, chunk_ids=40)
    rows = sorted(bitplane.report(llm, path).collect(), key=lambda r: r.start)
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in bitplane.read_ids(llm, path).collect()}
    start = 0
    for row in rows:
        text = dict([*ODD, *hard])[row.doc_id]
        want = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        assert ids[row.doc_id] == want and (row.start, row.n_tokens) == (start, len(want))
        assert row.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 6, 6, 20, 21, 22, 23]
    empty = shared_dir(llm)
    bitplane.write_ids(odd(llm, []), empty, public.path("byte_bpe_50k.json"))
    assert bitplane.report(llm, empty).count() == 0


def test_bitplane_encodes_added_tokens(llm):
    """The ids of the query are those of an untouched tokenizer, literals of added tokens included."""
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "x<|endoftext|>", "<|endoftext|><|endoftext|> y, z.", "<|endoftext plain |>", "It's plain."]
    path = shared_dir(llm)
    odd(llm, list(enumerate(texts))).write.parquet(f"{path}/documents.parquet")
    rows, start = {r.doc_id: r for r in queries.QUERIES["op5_bitplane"](llm, path).collect()}, 0
    for i, text in enumerate(texts):
        want = [*whole.encode(text, add_special_tokens=False).ids, 2]
        assert (rows[i].start, rows[i].n_tokens) == (start, len(want))
        assert rows[i].ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)


def test_planes_of_any_ids():
    ids = np.random.default_rng(0).integers(0, 1 << 32, 40_001, dtype=np.uint32)
    for kind in ("byte", "bit"):
        assert (bitplane.from_planes(bitplane.to_planes(ids, kind), len(ids), kind) == ids).all()


def test_packing_is_optimal():
    random = np.random.default_rng(3)
    for _ in range(30):
        lengths = np.unique(random.integers(1, 60, 8))
        counts = random.integers(1, 9, len(lengths))

        def padding(ends):
            return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))

        from itertools import combinations
        best = min(padding([*e, lengths[-1]]) for k in range(3) for e in combinations(lengths[:-1], k))
        assert padding(packing.optimal_boundaries(lengths, counts, 3)) == best


def test_packing_rows(llm):
    got = packing.packed(odd(llm)).collect()
    assert len(got) == len(ODD) and all(r.padding >= 0 and r.n_tokens + r.padding == r.bucket_tokens for r in got)
    assert packing.packed(odd(llm, [])).count() == 0
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    batches = defaultdict(list)
    for r in packing.packed(docs, budget=4_000).collect():
        batches[r.bucket, r.slice, r.batch].append(r)
    for rows in batches.values():
        assert len(rows) == 1 or sum(r.bucket_tokens for r in rows) <= 4_000
        assert sorted(r.position for r in rows) == list(range(len(rows)))


def test_pca_dedup_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0),
            (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [], 0), (10, [1.0, None], 0), (11, [1.0, 0.0, 0.0], 0),
            (None, [1.0, 0.0], 0)]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in pca_dedup.deduplicated(frame).collect())
    alone = [(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    assert got == sorted([(0, 0, None, False), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), *alone])
    assert pca_dedup.deduplicated(frame.limit(0)).count() == 0


def test_tiles_find_every_link(llm, monkeypatch):
    monkeypatch.setattr(pca_dedup, "TILE", 7)
    random = np.random.default_rng(6)
    centre = random.standard_normal((12, 24))
    x = (centre[random.integers(0, 12, 150)] + 0.14 * random.standard_normal((150, 24))).astype(np.float32).astype(float)
    frame = llm.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in pca_dedup.deduplicated(frame).collect()}
    assert want.sum() > 50 and [got[i] for i in range(150)] == want.tolist()


def test_site_style(llm):
    def page(body, article="<p>Own &amp; text <b>here</b><br>more<p>Second\n  one"):
        return f"<html><head><title>T</title></head><body><nav><a>Home</a></nav>{body}<article><h1>Head</h1>{article}</article>"

    cases = [
        (1, "http://a.example/x", page("<div class='ad'>Buy</div>"), "Head\nOwn & text here more\nSecond one"),
        (2, "http://a.example/y", page("", "<p>x</p><div class=comments><p>Nice!</p></div><form>q</form><script>'</p>'</script>"), "Head\nx"),
        (3, None, None, ""), (4, "", "", ""), (5, "u", "plain &lt;text&gt;", "plain <text>"),
        (6, "http://b.example/", "<p>No article<aside>side</aside><footer>f</footer>", "No article"),
        (7, "http://b.example/", "<article><p>broken <a href=\"x", "broken")]
    cases += [(100 + k, "http://c.example/", f"<div><div class=t>Same banner</div><p>Story {k}</p></div>", f"Story {k}") for k in range(60)]
    frame = llm.createDataFrame([c[:3] for c in cases], "page_id long, url string, html string")
    got = {r.page_id: r for r in site_style.extracted(frame).collect()}
    for i, _, _, text in cases:
        assert (got[i].text, got[i].n_chars) == (text, len(text))
    assert site_style.extracted(frame.limit(0)).count() == 0


def test_site_style_names_around_the_page():
    story, teaser = "<article><p>A long enough story here</p></article>", "<div class=related><article><p>Teaser</p></article></div>"
    for frame in ('<div class="layout has-sidebar">', '<section id="page" class="with-comments">', "<form>", "<label>"):
        assert site_style.main_text(f"<body>{frame}<nav>Home</nav>{story}{teaser}", set()) == "A long enough story here"
        assert site_style.main_text(f"<body>{frame}<nav>Home</nav><p>A long enough story here</p>", set()) == "A long enough story here"
    assert site_style.main_text(f"<body>{story}<div class=comments><p>{'Nice! ' * 40}</p></div>", set()) == "A long enough story here"


def test_importance_of_tree_nodes(llm):
    """Entropies of every node against their definition."""
    pages = llm.read.parquet(f"{SF}/pages.parquet")
    sites = defaultdict(list)
    for r in pages.withColumn("host", site_style.host()).collect():
        found = [b for b in site_style.blocks(r.html) if not b.noise]
        texts, children = defaultdict(set), defaultdict(list)
        for b in found:
            texts[b.path].add(b.text)
            children[b.path.rpartition("/")[0]].append(b.path.rpartition("/")[2])
        for path in texts:
            sites[r.host, path].append((texts[path], tuple(children.get(path, ()))))
    got = {(r.host, r.node): r for r in site_style.style_tree(pages).collect()}
    assert got.keys() == sites.keys()
    for key, seen in sites.items():
        k = len(seen)
        spread = Counter(t for texts, _ in seen for t in texts)
        content = 1.0 if k == 1 else max(0.0, 1 - sum(j * np.log(j) for j in spread.values()) / (spread.total() * np.log(k)))
        shapes = Counter(shape for _, shape in seen if shape)
        want = content
        if shapes.total() > 1:
            share = np.array(list(shapes.values())) / shapes.total()
            want = max(content, (content + min(1.0, -(share * np.log(share)).sum() / np.log(max(k, 2)))) / 2)
        assert (got[key].pages, got[key].importance) == (k, pytest.approx(want, abs=1e-9))


def test_the_tree_decides(llm):
    """Each page differs with and without the tree's evidence: teasers, boxes without a name, text beside an article."""
    teasers = "".join(f"<article><div><h2>Top story {k}</h2></div></article>" for k in range(3))
    sites = {
        "teasers": lambda k: (f"<body>{teasers}<div><p>Report number {k} in full</p></div>", f"Report number {k} in full"),
        "unnamed": lambda k: (f"<body><div><i>All rights reserved</i></div><p>Page text {k}</p>", f"Page text {k}"),
        "beside": lambda k: (f"<body><article><p>Lead {k}</p></article><section><p>Background {k}</p></section><div>Every page</div>",
                             f"Lead {k}\nBackground {k}"),
        "inside": lambda k: (f"<body><article><p>Own {k}</p><section><p>Read our letter</p></section></article>", f"Own {k}"),
        "copies": lambda k: ("<body><article><p>The same article</p></article><div>Imprint</div>", "The same article"),
        "ads": lambda k: (f"<body><article><p>Own {k}</p></article><div class=ad>Buy {k}</div><footer>No {k}</footer>", f"Own {k}"),
    }
    for m in (8, 40):
        rows = [(1000 * i + k, f"https://{name}.example/{k}", *page(k)) for i, (name, page) in enumerate(sites.items()) for k in range(m)]
        frame = llm.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
        got = {r.page_id: r.text for r in site_style.extracted(frame).collect()}
        assert {r[0]: r[3] for r in rows} == got
        differs = {r[1].split(".")[0][8:] for r in rows if site_style.main_text(r[2], {}) != r[3]}
        assert differs == {"teasers", "unnamed", "beside", "inside"}


def test_site_style_on_the_pages(llm):
    pages = llm.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in site_style.extracted(pages).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(x for x in parts if x)


def _strict(text):
    """The strict forms, written out once more."""
    out, text = [], text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m[0].split("."))) <= 255:
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(x) for x in digits(m[0])]
        if 16 <= len(d) <= 19 and sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii(llm):
    hard = [(30, "a@b.c@d.ee x_y%z@q.io +1 (222) 333-4444 4111 1111 1111 1111 1.2.3.4.5 300.1.1.1 001.002.003.004"),
            (31, "4111-1111-1111-1112 +12 +1234567890123456 é@x.y p@q"), (32, "9" * 4_000 + ".1.1.1")]
    docs = llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd(llm, [*ODD, *hard]).select("doc_id", "text"))
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    rows = pii_boost.found(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = {hashlib.sha256(pii_boost.listed(_strict(t)).encode()).hexdigest() for t in texts[r.doc_id]}
        assert r.base_sha256 in want
        if len(want) == 1:
            assert r.n_phone == sum(k == "phone" for k, _, _ in _strict(texts[r.doc_id][0]))
            assert set(pii_boost.listed(_strict(texts[r.doc_id][0])).split(",")) <= set(r.spans.split(","))
    assert pii_boost.base_spans("9" * 5_000 + ".1.1.1") == []


def test_candidates_that_overlap_strict_spans_are_judged(llm):
    """The trees widen an address beyond its strict form, and reject telephone numbers seen in a card."""
    model = pii_boost.train(llm.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    wide, card = "Contact jörg.müller@firma.de now", "My card 4111 1111 1111 1111 is old"
    (strict, every), (own, all_of_card) = pii_boost.accepted([wide, card], model)
    assert strict == [("email", wide.index("ller@"), 28)] and every == [("email", 8, 28), *strict]
    assert pii_boost.masked(wide, every) == "Contact [EMAIL] now"
    assert ("phone", *own[0][1:]) in pii_boost.candidates(card) and all_of_card == own == [("card", 8, 27)]
    assert pii_boost.accepted([wide], model, threshold=1.1) == [(strict, strict)]
    found = pii_boost.candidates("name(AT)firma.de, <a.b@c.org>. Or x@y.com!")
    assert ("email", 0, 16) in found and ("email", 19, 28) in found and ("email", 34, 41) in found


def test_pii_masks(llm):
    assert pii_boost.masked("x a@b.cc y", [("email", 2, 8), ("phone", 4, 9)]) == "x [EMAIL]y"
    assert pii_boost.found(odd(llm, [])).count() == 0


def test_boosting_separates():
    x = np.random.default_rng(1).standard_normal((600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    assert ((pii_boost.Boosted(x, y).probability(x) > 0.5) == y).mean() > 0.95


def test_grammar_weighs_clauses():
    scorer = toxicity.Scorer({"idiot$": 4.0})
    plain, negated, reported, aimed = (
        sum(scorer.clauses(t)[0]) for t in ("what an idiot", "he is not an idiot", "they said idiot", "you idiot"))
    assert negated < plain and reported < plain < aimed
    assert scorer.clauses("idiotic idea") == ([], 0) and scorer.clauses(None) == ([], 0)


def test_threats_count_once_a_target_is_known():
    scorer = toxicity.Scorer({})

    def score(text):
        return sum(scorer.clauses(text)[0])

    for threat in ("I will kill you", "you I will kill", "they are shooting him", "ich will dich schlagen", "wir schlagen euch"):
        assert score(threat) == pytest.approx(2.0), threat
    assert score("I will not kill you") < 1.2 and score("she said I will kill you") < 1.3
    assert score("time to kill") == score("it was hurting. you") == pytest.approx(0.1)
    assert score("you and your friends met him") == 0 and score("no threat to them or you") == 0
    assert {"kills", "stabbed", "stabbing", "destroying", "schlage", "tuent", "matan"} <= toxicity.inflected(toxicity.THREAT)


def test_classifiers_on_held_out_rows(llm):
    sf = "/root/testdata/sf0.01"
    docs, marks = (llm.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r for r in marks.collect()}
    rows = [r for r in knn_quality.scored(docs, marks).collect() if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id].quality for r in rows) >= 0.97 * len(rows)
    rows = [r for r in toxicity.scored(docs, marks).collect() if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id].toxic for r in rows) >= 0.9 * len(rows)


@pytest.mark.parametrize("operator", [knn_quality.scored, toxicity.scored])
def test_classifiers_on_odd_rows(llm, operator):
    marks = labels(llm, [(5, 1, 0), (3, 0, 1), (4, 1, None), (None, 1, 1)])
    for docs, mark in ((odd(llm), marks), (odd(llm), labels(llm)), (odd(llm, []), marks)):
        got = operator(docs, mark).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)


def test_pipeline_stages(llm):
    docs, counts = llm.read.parquet(f"{SF}/documents.parquet"), []
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = shared_dir(llm)
        stage(llm, docs, SF).write.parquet(path)
        before, docs = docs, llm.read.parquet(path)
        counts.append(docs.count())
        if name == "n-gram Jaccard join":
            groups = _brute_components({r.doc_id: r.text for r in before.collect()})
            assert sorted(r.doc_id for r in docs.collect()) == sorted(set(groups.values()))
        if name == "PII":
            assert not any(_strict(r.text) for r in docs.collect())
        if name != "packing":
            assert docs.columns == names
    assert corpus_pipeline.run(llm, SF).count() == counts[-1]


WORDY = " ".join(f"w{i}" for i in range(60))
AWKWARD = [
    (None, WORDY), (None, WORDY), (None, f"{WORDY} more"), (4, "another text " + WORDY[::-1]), (4, f"{WORDY} more"), (7, WORDY), (7, WORDY),
    (9, ""), (9, None), (None, None), (None, ""), (11, "only here " * 9), (11, "only here " * 9), (None, "nameless but single " * 8)]


def test_one_row_of_each_component_stays(llm):
    """NULL ids, one id with two texts, repeated rows, empty texts."""
    docs = odd(llm, AWKWARD).withColumnRenamed("node", "text_key")
    kept = jaccard_join.deduplicated(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text or "") for r in kept.collect()))
    # the component of WORDY is named by document 4's second text; its first text is linked with nothing
    assert got == sorted([(4, f"{WORDY} more"), (4, "another text " + WORDY[::-1]), (9, ""), (9, ""), (0, ""), (0, ""),
                          (11, "only here " * 9), (0, "nameless but single " * 8)])
    assert jaccard_join.deduplicated(odd(llm, [])).count() == 0


def test_wide_sketches_bound_the_difference():
    random = np.random.default_rng(8)
    for n in (1_025, 2_048, 2_049, 9_000):
        a = np.unique(random.integers(0, 1 << 62, n, dtype=np.uint64))
        for m in (n, int(n * 0.9), int(n * 1.2)):
            b = np.unique(np.r_[a[:min(m, n) - 40], random.integers(0, 1 << 62, max(m - n, 0) + 40, dtype=np.uint64)])
            other = np.unique(random.integers(0, 1 << 62, m, dtype=np.uint64))
            if len(b) > 1_024 and len(other) > 1_024:
                x, y, z = map(jaccard_join.wide_sketch, (a, b, other))
                assert 0 < jaccard_join.wide_distance(x, y) == jaccard_join.wide_distance(y, x) <= len(np.setxor1d(a, b))
                assert jaccard_join.wide_distance(x, z) * 180 > (n + m) * 20  # unrelated sets are ruled out
    assert jaccard_join.wide_sketch(np.arange(1_024, dtype=np.uint64)) is None


def test_long_texts_are_linked(llm):
    random = np.random.default_rng(2)
    words = [f"v{i}" for i in random.integers(0, 400, 6_000)]
    near, far = list(words), list(words)
    near[10:3_000:60] = ["changed"] * len(near[10:3_000:60])  # 50 of 6,000 words, about 250 shingles
    far[::20] = ["changed"] * len(far[::20])  # a quarter of the shingles each way
    texts = [" ".join(x) for x in (words, near, far, words[:5_200], words[:3_000], random.permutation(words))]
    got = {r.doc_id: r.component_id for r in jaccard_join.joined(odd(llm, list(enumerate(texts)))).collect()}
    assert got == _brute_components(dict(enumerate(texts))) and got[1] == got[3] == 0 and got[2] == 2


def test_decontaminate_with_a_state_column(llm, monkeypatch):
    bench = llm.createDataFrame([(7, "C d, E"), (8, "k l")], "item_id long, text string")
    docs = odd(llm).withColumnRenamed("node", "_state").withColumnRenamed("score", "_STATE_")
    kept = decontaminate.cleaned(docs, bench)
    assert kept.columns == docs.columns
    want = sorted((r.doc_id or 0, r.text or "", r._state) for r in kept.collect())
    assert (5, "a b f g h i j ", "z") in want or any(r[0] == 5 and r[1].split() == list("abfghij") for r in want)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2)
    monkeypatch.setattr(decontaminate, "BLOCKS_AT_ONCE", 1)
    assert sorted((r.doc_id or 0, r.text or "", r._state) for r in decontaminate.cleaned(docs, bench).collect()) == want


def test_pipeline_on_odd_rows(llm, tmp_path):
    """Every stage and the whole pipeline on NULLs, repeats, clashing names, and on empty tables."""
    for rows, folder in ((ODD + AWKWARD, tmp_path / "odd"), ([], tmp_path / "none")):
        docs = odd(llm, rows).withColumnRenamed("node", "_state")
        docs.write.parquet(f"{folder}/documents.parquet")
        labels(llm, [(1, 1, 0), (2, 0, 1), (None, 1, None), (5, None, None)] if rows else []).write.parquet(f"{folder}/labels.parquet")
        llm.createDataFrame([(7, "C d, E"), (8, None)] if rows else [], "item_id long, text string").write.parquet(
            f"{folder}/benchmark.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(llm, docs, str(folder))
            assert out.count() <= len(rows) and (name == "packing" or out.columns == docs.columns)
        corpus_pipeline.run(llm, str(folder)).collect()
