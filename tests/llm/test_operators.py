"""Each operator against a brute-force version, on small tables with every odd case."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from reviewloom.llm import (
    chat,
    decontamination,
    mixing,
    repeats,
    repetition,
    secret_scan,
    sharding,
    simhash,
    site_text,
    tokens,
)
from reviewloom.llm.components import components
from reviewloom.llm.difference_cover import suffix_order

DOCS = "doc_id bigint, text string, lang string, source string, size bigint, shard string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like ours."""
    rng = random.Random(4)
    syllables = ["ba", "ke", "no", "ti", "ru", "é", "sel", "mor"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    texts = [None, "", "  \n ", "one", "Token=abcdefghijkl12 x", text(6000)]
    texts += [text(rng.randint(1, 200)) for _ in range(30)]
    texts += [texts[8]] * 4 + [texts[9] + " end", "a " * 300, "same line\n" * 60]
    rows = [(i, t, "en", f"s{i % 4}", 1, "x") for i, t in enumerate(texts)]
    rows += [(3, "one", "en", "s3", 1, "x"), (None, text(60), None, None, None, None)]
    return spark.createDataFrame(rows, DOCS), rows


def test_secrets(spark, odd):
    pattern = re.compile(
        r"(?:[pP][aA][sS][sS](?:[wW][oO][rR][dD]|[wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
        r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    kinds = (("assign", pattern, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 18), ("hex", re.compile("[0-9a-f]+"), 16))

    def brute(text):
        found = [
            (m.start(), i, kind, m.end())
            for i, (kind, rule, least) in enumerate(kinds)
            for m in rule.finditer(text)
            if len(m[1] if rule.groups else m[0]) >= least
        ]
        return [(kind, begin, end) for begin, _, kind, end in sorted(found)]

    rng = random.Random(1)
    parts = ["token", "secret=", "token:", "abcdef012345", "AKIA", "ABCD1234", '"', " ", "=", "é", "passwd", "api_key", ":", "'"]
    scanner = secret_scan.Scanner()
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        assert [s for s in scanner.spans(text) if s[0] in ("assign", "access", "hex")] == brute(text)
    more = {
        "private_key": "-----BEGIN RSA PRIVATE KEY-----",
        "github": "ghp_" + "aZ09" * 9,
        "gitlab": "glpat-" + "a-Z_9" * 4,
        "google": "AIza" + "aZ-_9" * 7,
        "npm": "npm_" + "xY01" * 9,
        "slack": "xoxb-" + "12345-abcde" * 2,
        "stripe": "sk_live_" + "wX01" * 6,
        "json_web_token": "eyJhbGci.eyJzdWIi.sig-1",
    }
    assert list(more) == [rule.kind for rule in secret_scan.MORE]
    text, places = "é", []
    for kind, secret in more.items():
        places.append((kind, len(text) + 1, len(text) + 1 + len(secret)))
        text += " " + secret + " é"
        assert [s for s in scanner.spans(f"é {secret[:-9]} é") if s[0] == kind] == [] or kind == "json_web_token"
    assert [s for s in scanner.spans(text) if s[0] in more] == places
    frame, rows = odd
    got = collections.Counter((r["doc_id"], r["base_sha256"]) for r in secret_scan.secrets(frame).collect())
    assert got == collections.Counter((r[0], sha(secret_scan.joined(brute(r[1] or "")))) for r in rows)


def test_quality_rules(odd):
    frame, rows = odd
    for row in repetition.quality(frame).collect():
        text = next(r[1] for r in rows if r[0] == row["doc_id"]) or ""
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = collections.Counter(zip(found, found[1:], found[2:]))
        inside = {i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row["n_words"] == len(found) and row["word_chars"] == sum(map(len, found))
        assert row["n_repeat_words"] == len(inside)
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["base_failed"] == (len(found) < 50 or 100 * len(inside) > 50 * len(found))
        assert not (row["base_failed"] and row["kept"])
    kept = repetition.kept_documents(frame)
    assert kept.columns == frame.columns and kept.count() < frame.count()


def test_token_counts(odd):
    frame, rows = odd
    library = Tokenizer.from_file(tokens.vocabulary_path())
    want = collections.Counter((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in tokens.token_counts(frame).collect()) == want
    counter = tokens.TokenCounter(tokens.vocabulary_path())
    for text in ("<|endoftext|> a", "", "it's  x\r\n\t y", "९ 12 ² ok’s 👍🏽", "\x1c\x85 \xa0"):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_mixing(odd):
    frame, rows = odd
    found = mixing.mix(frame).collect()
    assert len(found) == len(rows)
    total = sum(r["size"] for r in found)
    by_source = {}
    for r in found:
        by_source.setdefault(r["target"], r["source_size"])
        assert r["taken"] <= 3 * r["size"]
    names = {r[3] for r in rows}
    per = {(r["source_size"], r["target"]) for r in found}
    assert len(per) <= len(names) and sum(t for _, t in per) == pytest.approx(total)
    assert all(t <= 3 * s for s, t in per)
    again = mixing.mix(frame).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))
    copies = mixing.training_set(frame)
    assert copies.columns == frame.columns


def test_shares_are_filled_like_water(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), (None, 50), ("c", 0)], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # a is cut at 30; c has nothing; b (weight 2) and null (weight 5, the fourth) share 130
    assert got == pytest.approx({"a": 30, "b": 130 * 2 / 7, "c": 0, None: 130 * 5 / 7})


def test_sharding(odd):
    frame, rows = odd
    found = sharding.shards_of(frame, 4).collect()
    assert len(found) == len(rows)
    slots = collections.defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded_documents(frame, 4).columns == ["doc_id", "text", "lang", "source", "size", "shard", "slot"]


def stored_docs(spark, path, rows):
    """Documents as a table of several files, whose rows keep their places."""
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.mark.parametrize("same_id", [7, None])
def test_shards_of_many_repeated_rows_are_equal_in_bytes(spark, tmp_path, same_id):
    """Two fifths of the rows are one row; sources share a long prefix."""
    rng = random.Random(11)
    names = [f"https://site{k}.org" for k in range(16)]
    rows = [(i, "x" * rng.randint(20, 80), "en", rng.choice(names), 1, "s") for i in range(600)]
    rows += [(same_id, "the same text of every copy, fifty characters long", None, names[3], 1, "s")] * 400
    found = sharding.shards_of(stored_docs(spark, tmp_path / "docs", rows), 16).collect()
    assert len(found) == 1000
    weights, slots = collections.Counter(), collections.defaultdict(list)
    for r in found:
        weights[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(weights.values()) / 16
    assert len(weights) == 16
    assert max(abs(w - mean) for w in weights.values()) <= 2 * 81
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sources_of_one_prefix_are_split_by_source(spark, tmp_path):
    rng = random.Random(12)
    rows = [(i, "x" * rng.randint(50, 60), "en", f"https://site{i % 16:02d}.org", 1, "s") for i in range(1600)]
    rows += [(2000, "far", "en", "zzz", 1, "s"), (2001, "none", "en", None, 1, "s")]
    found = sharding.sharded_documents(stored_docs(spark, tmp_path / "docs", rows), 16).collect()
    per = collections.defaultdict(set)
    for r in found:
        per[r["shard"]].add(r["source"])
    assert max(map(len, per.values())) <= 5


@pytest.mark.parametrize("small", [True, False])
def test_equal_texts_lie_in_one_shard(spark, tmp_path, monkeypatch, small):
    """Copies under several sources and languages; one group weighs more than a shard, and is
    cut, as the shards could not be near each other in bytes otherwise."""
    rng = random.Random(13)
    texts = ["y" * rng.randint(20, 60) + str(k) for k in range(400)]
    texts = [t for t in texts for _ in range(rng.randint(2, 4))] + ["z" * rng.randint(20, 60) + str(k) for k in range(2500)]
    texts += ["heavy group " * 4] * 1200 + ["", None, ""]
    rng.shuffle(texts)
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), 1, "s") for i, t in enumerate(texts)]
    if not small:
        monkeypatch.setattr(sharding.sizing, "is_small", lambda *_: False)
    found = sharding.shards_of(stored_docs(spark, tmp_path / "docs", rows), 16).collect()
    weights, shards = collections.Counter(), collections.defaultdict(set)
    for r in found:
        weights[r["shard"]] += r["size"]
        shards[texts[r["doc_id"]] or ""].add(r["shard"])
    mean = sum(weights.values()) / 16
    assert sorted(r["doc_id"] for r in found) == list(range(len(texts)))
    assert all(abs(w - mean) <= sharding.WHOLE * mean + 60 for w in weights.values()) and len(weights) == 16
    assert [text for text, own in shards.items() if len(own) > 1] == ["heavy group " * 4]


def test_ranks_are_dense_and_in_order(spark):
    values = [f"v{k:03d}" for k in range(300)] + [None]
    frame = spark.createDataFrame([(v,) for v in values * 2], "source string").repartition(6)
    found = {r["value"]: r["rank"] for r in sharding._ranked(frame, "source").collect()}
    assert found == {v: k for k, v in enumerate(sorted(v for v in values if v))}


def fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints):
    """Component of each fingerprint, by comparing all."""
    group = {p: p for p in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 4 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {p: low if g == high else g for p, g in group.items()}
    return group


def test_simhash(odd):
    frame, rows = odd
    prints = {(r[0], r[1]): fingerprint(r[1] or "") for r in rows}
    group = linked(set(prints.values()))
    least = {}
    for (doc_id, _), p in prints.items():
        if doc_id is not None:
            least[group[p]] = min(least.get(group[p], doc_id), doc_id)
    got = collections.Counter(map(tuple, simhash.near_duplicates(frame).collect()))
    assert got == collections.Counter(
        (r[0], f"{prints[r[0], r[1]]:016x}", least.get(group[prints[r[0], r[1]]])) for r in rows
    )
    assert simhash.representatives(frame).columns == frame.columns


def groups_with_shared_ids():
    """Ten groups of near copies: null ids, ids of two groups, repeated rows."""
    rng = random.Random(6)
    text = lambda: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(120))
    base = [text() for _ in range(10)]
    near = [t.replace(" ", "  ", 3) for t in base]  # the same words
    ids = [(None, None), (None, None), (None, 5), (5, 5), (5, 6), (7, None), (7, 7), (8, 1), (None, None), (2, 2)]
    rows = [(i, t) for a, b, (x, y) in zip(base, near, ids) for i, t in ((x, a), (y, b))]
    return rows + [rows[0], rows[6], rows[6]]


def one_per_group(rows):
    groups = collections.defaultdict(list)
    prints = {text: fingerprint(text) for _, text in rows}
    group = linked(set(prints.values()))
    for doc_id, text in rows:
        groups[group[prints[text]]].append((doc_id is None, doc_id or 0, sha(text), doc_id, text))
    return sorted((min(g)[3:] for g in groups.values()), key=repr)


def test_every_group_keeps_one_row(spark):
    rows = groups_with_shared_ids()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, simhash.representatives(frame).collect()), key=repr)
    assert got == one_per_group(rows) and len(got) == 10


def test_pipeline_keeps_every_group(spark, tmp_path):
    rows = groups_with_shared_ids()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    item = "Seven small boats drift past the harbour wall while the tide turns slowly away tonight."
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["text"]) for r in got} == set(one_per_group(rows))


@pytest.mark.parametrize("pairwise", [1024, 3])
def test_links_of_a_family(spark, pairwise):
    rng = random.Random(5)
    base, family = rng.getrandbits(64), set()
    for _ in range(60):
        bits = base
        for b in rng.sample(range(64), rng.randint(0, 7)):
            bits ^= 1 << b
        family.add(bits)
    group = linked(family)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in family], "bits bigint")
    got = collections.defaultdict(set)
    for r in components(simhash.links(frame, pairwise)).collect():
        got[r["component"]].add(r["node"])
    want = collections.defaultdict(set)
    for p, g in group.items():
        want[g].add(simhash._signed(p))
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_suffix_order():
    rng = random.Random(1)
    for size in [*range(1, 30), 400]:
        text = np.array([rng.randint(1, 3) for _ in range(size)], np.int64)
        want = sorted(range(size), key=lambda i, t=text.tolist(): t[i:])
        assert suffix_order(text, 99).tolist() == want


@pytest.mark.parametrize("crowded", [4096, 2])
def test_repeats(spark, odd, crowded):
    rng = random.Random(2)
    pool = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(60, 300))) for _ in range(8)]
    docs = {
        i: "".join(rng.choice(pool)[rng.randint(0, 40) :] if rng.random() < 0.8 else "ab" * 90 for _ in range(rng.randint(0, 6)))
        for i in range(50)
    }
    docs[3], docs[7] = None, docs[8]
    first, want = set(), {}
    for i, text in docs.items():
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in first:
                gone[p : p + 100] = True
            first.add(window)
        kept = bytes(c for c, r in zip(data, gone) if not r)
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(gone) else 0
        want[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    frame = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.without_repeats(frame, crowded).collect()}
    assert got == want
    assert repeats.without_repeats(odd[0]).count() == len(odd[1])


@pytest.mark.parametrize("doc_id", [None, 5])
@pytest.mark.parametrize("crowded", [4096, 2])
def test_repeats_of_documents_with_one_id(spark, doc_id, crowded):
    """Texts of one id that agree in the first 20 bits of their xxhash64, as many do by chance."""
    rng = random.Random(8)
    shared = "".join(rng.choices("abcdefgh", k=150))
    texts = [shared + f"{i:05d}" + ("x" * 40 if i % 2 else "") for i in range(4000)]
    ties = collections.defaultdict(list)
    for text in texts:
        ties[xxhash.xxh64_intdigest(text, 42) >> 44].append(text)
    same = next(group[:2] for group in ties.values() if len(group) > 1)
    rows = [(doc_id, text) for text in [*same, same[0], "".join(rng.choices("ijklmnop", k=180))]]
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), crowded).collect()
    left = collections.Counter((r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)
    # the shared beginning goes from one of the two texts; a repeated row is one document
    whole = lambda text: (0, 0, sha(text))
    a, b, other = same[0], same[1], rows[3][1]
    n = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
    cut = lambda text: (n, 1, sha(text[n:]))
    assert left in (
        collections.Counter([whole(a), whole(a), cut(b), whole(other)]),
        collections.Counter([cut(a), cut(a), whole(b), whole(other)]),
    )


def test_decontamination(spark, odd):
    frame, rows = odd
    item = "Seven small boats drift past the harbour wall while the tide turns slowly away tonight."
    head, tail = item.split(" wall ")
    extra = [
        (901, f"before. {item.upper()} after", "en", "s", 1, "x"),
        (902, f"{tail} and then. {head}, WALL while", "en", "s", 1, "x"),
        (903, "seven small boats drift past, and nothing else of it", "en", "s", 1, "x"),
    ]
    docs = frame.unionByName(spark.createDataFrame(extra, DOCS))
    items = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, "--")], "item_id bigint, text string")
    found = decontamination.contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(901, 1), (902, 1)}
    clean = decontamination.clean_documents(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 2
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


def brute_tiles(item, text, least):
    """The longest match of unmarked tokens first, until none has ``least``."""
    free_item, free_text = [True] * len(item), [True] * len(text)
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while (
                    i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k]
                    and free_item[i + k] and free_text[j + k]
                ):
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        size, i, j = best
        if size < least:
            return free_item.count(False)
        free_item[i : i + size] = free_text[j : j + size] = [False] * size


def test_tiles_equal_brute_force():
    rng = random.Random(13)
    for _ in range(400):
        letters = rng.choice([2, 3, 8])
        item, text = (
            np.array([rng.randrange(letters) + 1 for _ in range(rng.randint(0, 30))], np.uint64) for _ in "ab"
        )
        least = rng.choice([1, 2, 3, 5])
        assert decontamination.tiled(item, text, least) == brute_tiles(item.tolist(), text.tolist(), least)


def test_long_pairs_are_tiled_at_once():
    rng = np.random.default_rng(14)
    item = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    text = item.copy()
    text[::7] += np.uint64(1)
    # all but every seventh token, and the one token that stands last by itself
    assert decontamination.tiled(item, text) >= 20_000 * 6 // 7 - 6


def test_pairs_equal_brute_force_over_all_items(spark):
    """Items of 0 to 12 tokens, short ones as whole runs, some without spaces."""
    rng = random.Random(15)
    word = lambda: rng.choice(["ka", "lo", "mi", "ne", "pu"])
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 12)))) for i in range(25)]
    items += [(30, "漢字を切り分ける文です"), (31, "長い文"), (32, None)]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 60))), "", "", 0, "") for i in range(60)]
    docs += [(70, "前に漢字を切り分ける文です。後", "", "", 0, ""), (71, "長 い文だ", "", "", 0, ""), (72, None, "", "", 0, "")]
    cut = lambda t: decontamination.token_hashes(t or "").tolist()
    want = set()
    for d, text, *_ in docs:
        for i, item in items:
            tokens = cut(item)
            covered = tokens and brute_tiles(tokens, cut(text), min(5, len(tokens)))
            if tokens and covered >= decontamination.LEAST_COVERAGE * len(tokens):
                want.add((d, i, covered, len(tokens)))
    found = decontamination.contaminated(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    assert {(70, 30), (71, 31)} <= {(r["doc_id"], r["item_id"]) for r in found}
    assert {(r["doc_id"], r["item_id"], r["covered"], r["item_tokens"]) for r in found} == want


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a</p><svg/><p>b</p><p>c</p>", "a\nb\nc"),
        ("<p>1</p><svg d=\"a/>b\"><path d='m'/></svg><p>2</p>", "1\n2"),
        ("<article><title-bar></title-bar><p>x</p></article>", "x"),
        ("<template-card>y</template-card><p>z</p>", "y\nz"),
        ('<article><h2 id="related-work">r</h2><p class="share-price">s</p></article>', "r\ns"),
        ('<article><section id="comments-on-law"><p>c</p></section></article>', "c"),
        ('<article><p>a</p><div class="x comments"><p>no</p></div></article>', "a"),
        ("<form><nav>n</nav><article><p>kept</p><form>no</form></article><div>no</div></form>", "kept"),
        ("<aside><article><p>teaser</p></article></aside><main><p>m</p></main>", "m"),
        ("<p data-x=it's>y", "y"),
        ("<p title=\"a>b\">y</p>", "y"),
        ("<script>if(a<b)x='</p>'</script ><p>t", "t"),
    ],
)
def test_markup_of_every_kind(html, text):
    assert site_text.Page(html).text == text


def test_broken_markup_takes_no_longer():
    assert site_text.Page("<a " + 'x="1" ' * 20_000).text.startswith("<a")


def test_mixing_of_rows_that_share_an_id(spark):
    """A third of the ids are null: their rows spread over the ranges, and targets are met."""
    rng = random.Random(16)
    rows = [
        (None if i % 3 == 0 else i, " ".join(["w"] * rng.randint(1, 9)) + f" {i}", "en", f"s{i % 4}", 1, "x")
        for i in range(900)
    ]
    frame = spark.createDataFrame(rows, DOCS)
    found = mixing.mix(frame).collect()
    taken, targets = collections.Counter(), {}
    key = {(r[0], len(r[1].split())): r[3] for r in rows}
    for r in found:
        if r["doc_id"] is not None:
            targets[key[r["doc_id"], r["size"]]] = (r["target"], r["source_size"])
    for r in found:
        taken[(r["target"], r["source_size"])] += r["taken"]
    assert len(set(targets.values())) == 4
    assert all(abs(taken[t] - t[0]) <= 10 for t in targets.values())


def test_site_text(spark):
    def page(body, chrome):
        return f"<html><head><title>t</title></head><body><nav>menu</nav><div>{chrome}</div>{body}<footer>f</footer>"

    rows = [
        (i, "http://h.org/a", page(f"<article><h1>T &amp; {i}</h1><p><b>one\n two<br>x<p>three</article>", "same on all"))
        for i in range(12)
    ]
    rows += [
        (20, "http://h.org/b", page("<div>only here</div>", "same on all")),
        (21, None, None),
        (22, "http://h.org/c", ""),
        (22, "http://h.org/c", ""),
        (23, "x", "<script>var a='<p>no</p>'</script><p>yes<!-- no --></p><form>no</form>"),
    ]
    got = collections.Counter(
        (r["page_id"], r["text"])
        for r in site_text.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    )
    want = [(i, f"T & {i}\none two x\nthree") for i in range(12)]
    want += [(20, "only here"), (21, ""), (22, ""), (22, ""), (23, "yes")]
    assert got == collections.Counter(want)


def test_site_text_of_copies_and_small_sites(spark):
    def html(i, chrome="all rights"):
        return f"<body><div>top</div><section><p>story {i}</p></section><div>{chrome}</div>"

    def article(i):
        listed = "<ul><li>one</li><li><div>two</div></li></ul>"
        return f"<article><h1>{i}</h1><div><p>the same words</p></div>{listed}<div>like it</div></article>"

    # one page many times, of a site of one page and of a site of two
    rows = [(i, f"http://copies.org/{i}", html(0)) for i in range(30)] + [(30, "http://copies.org/0", html(0))] * 12
    rows += [(40 + i, f"http://two.org/{i}", html(i % 2)) for i in range(30)]
    rows += [(80 + i, f"http://four.org/{i}", html(i)) for i in range(4)]
    rows += [(100 + i, f"http://articles.org/{i}", article(i)) for i in range(15)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = collections.Counter((r["page_id"], r["text"]) for r in site_text.main_texts(frame).collect())
    want = [(r[0], "top\nstory 0\nall rights") for r in rows[:42]]
    want += [(40 + i, f"top\nstory {i % 2}\nall rights") for i in range(30)]
    want += [(80 + i, f"story {i}") for i in range(4)]
    want += [(100 + i, f"{i}\nthe same words\none\ntwo") for i in range(15)]
    assert got == collections.Counter(want)


def test_chat(spark):
    rng = random.Random(3)
    parts = ["<|im_end|>", "<", "|", "\\", "[INST]", "[", "/INST]", "</s>", "s>", "é", "\n", "<|im_start|>user\n"]
    rows = [
        (c, t, rng.choice(["user", "assistant", "a\\n\nb"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))))
        for c in range(40)
        for t in range(rng.randint(1, 5))
    ]
    rows.append((50, 0, "assistant", None))
    turns = collections.defaultdict(list)
    for c, _, role, text in rows:
        turns[c].append((role, text or ""))
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(chat.formatted_turns(frame)).collect()}
    learned = {c: "".join(t for r, t in x if r == "assistant") for c, x in turns.items()}
    assert got == {
        c: (len(x), sha("".join(f"{r}\n{t}\n" for r, t in x)), len(learned[c]), sha(learned[c])) for c, x in turns.items()
    }


EMPTY = {
    "secrets": secret_scan.secrets,
    "quality": repetition.quality,
    "tokens": tokens.token_counts,
    "mixing": mixing.mix,
    "sharding": sharding.shards_of,
    "simhash": simhash.near_duplicates,
    "repeats": repeats.without_repeats,
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_tables(odd, name):
    assert EMPTY[name](odd[0].limit(0)).collect() == []
