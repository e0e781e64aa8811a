"""URL filter, vector codes and filter audit against brute force, with nulls, empty and long values, ties and repeats."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from handover.llm import filteraudit, queries, urls, veccodes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship(spark)


# --- op11 URL filter


def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


URLS = [
    None, "", "no scheme", "http://", "://", "http://COM/", "http://com", "http://x.com?y=/en/", "https://Example.com/en/1?a=1&b=2#c",
    "https://notexample.com/en/", "https://www.example.com/en/", "https://a.www.example.com/en/x.html", "https://example.com/EN/",
    "ftp://a.net/es/", "ftp://a.net/fr", "ftp://net/fr/é", "http://a.b/x://c.com/", "http://u@h.com:80/en/", "http://\nx.com/\nen?q", "http://É.com/#/",
    "http://x.com//en/", "http://" + "a." * 50_000 + "com/" + "b/" * 50_000, "https://example.com/en/1?a=1&b=2#c",
]


@pytest.fixture(scope="module")
def url_pages(spark):
    rng = random.Random(3)
    many = [f"http://{rng.choice(['a', 'b.example', 'www.example', 'c'])}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randint(1, 10**6)}" for _ in range(600)]
    rows = [(i if i != 5 else None, u, "h", "r", 1, 2, "x", "y", "z") for i, u in enumerate(URLS + many)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string, f int, n int, score string, s_last_label string, blocked string").repartition(3)


def test_rules_equal_a_plain_reading(spark, url_pages):
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in urls.filter_urls(url_pages, queries.URL_RULES).collect())
    want = Counter()
    for r in url_pages.collect():
        host, path = plain_host_path(r["url"])
        rule = plain_rule(host, path)
        want[r["page_id"], host, path, rule and rule.name] += 1
    assert got == want


def test_verdicts_follow_rule_then_score(spark, url_pages):
    verdict = {r.name: r.verdict for r in queries.URL_RULES}
    out = urls.filter_urls(url_pages, queries.URL_RULES)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    for r in out.collect():
        assert r["verdict"] == (verdict[r["rule"]] if r["rule"] else ("block" if r["score"] > 0.5 else "allow"))


def test_features_of_a_url(spark):
    url = "https://a.b-c.Example.com/en/12/x.tar.gz?p=1&q=22&r#top"
    df = spark.createDataFrame([(url,), (None,), ("",), ("aabb",)], "url string")
    host, path = urls.host_and_path(F.col("url"))
    full, null, empty, plain = urls.shape(df.select("url", host.alias("host"), path.alias("path"))).collect()
    entropy = -sum(n / len(url) * math.log2(n / len(url)) for n in Counter(url).values())
    assert full["entropy"] == int(5 * entropy)
    assert (full["depth"], full["labels"], full["parameters"], full["dashes"]) == (3, 3, 3, 1)
    assert full["digits"] == int(32 * 5 / len(url)) and full["length"] == int(4 * math.log2(len(url)))
    assert [null[f] for f in urls.SHAPE] == [empty[f] for f in urls.SHAPE]
    assert plain["entropy"] == 5


def plain_boost(rows, base, trees, depth, rate):
    """The same greedy trees, from all rows and with every candidate split summed anew."""
    margins = [base] * len(rows)
    for _ in range(trees):
        gs = []
        for (x, y), m in zip(rows, margins):
            p = 1 / (1 + math.exp(-m))
            gs.append((math.floor((y - p) * urls._UNIT + 0.5) if y - p > 0 else -math.floor((p - y) * urls._UNIT + 0.5), math.floor(max(p * (1 - p), 1e-6) * urls._UNIT + 0.5)))
        nodes, leaf = {1: list(range(len(rows)))}, {}
        for _ in range(depth):
            new = {}
            for k, members in nodes.items():
                part = lambda ids: (sum(gs[i][0] for i in ids) / urls._UNIT, sum(gs[i][1] for i in ids) / urls._UNIT)
                worth = lambda g, h: g * g / (h + 1.0)
                g, h = part(members)
                best, gained = None, 1e-6
                for f in range(len(urls.FEATURES)):
                    for b in sorted({rows[i][0][f] for i in members})[:-1]:
                        lg, lh = part([i for i in members if rows[i][0][f] <= b])
                        gain = worth(lg, lh) + worth(g - lg, h - lh) - worth(g, h)
                        if gain > gained:
                            best, gained = (f, b, lg, lh), gain
                if best:
                    f, b, lg, lh = best
                    for side, ids, sg, sh in ((2 * k, [i for i in members if rows[i][0][f] <= b], lg, lh), (2 * k + 1, [i for i in members if rows[i][0][f] > b], g - lg, h - lh)):
                        new[side] = ids
                        for i in ids:
                            leaf[i] = rate * sg / (sh + 1.0)
            if not new:
                break
            nodes = new
        if not leaf:
            break
        margins = [m + leaf.get(i, 0.0) for i, m in enumerate(margins)]
    return margins


def test_trees_equal_plain_boosting(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(150):
        x = [rng.randint(0, 4) for _ in urls.FEATURES]
        rows.append((x, int(rng.random() < (0.9 if (x[0] > 2) ^ (x[5] > 1) else 0.2))))
    counted = Counter((tuple(x), y) for x, y in rows)
    df = spark.createDataFrame([(*x, y, n) for (x, y), n in counted.items()], ", ".join(f"{f} int" for f in urls.FEATURES) + ", blocked int, n long")
    trees = urls.boost(df, 0.1, 3, 3, 0.3)
    got = {tuple(r[f] for f in urls.FEATURES): r["m"] for r in df.select(*urls.FEATURES, urls.Model(0.1, trees, None).margin().alias("m")).collect()}
    want = plain_boost(rows, 0.1, 3, 3, 0.3)
    assert all(abs(got[tuple(x)] - m) < 1e-9 for (x, _), m in zip(rows, want))


def test_held_out_accuracy_on_ruled_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url", *(x.alias(n) for x, n in zip(urls.host_and_path(F.col("url")), ("host", "path"))))
    _, ruled = urls.matching_rule(F.col("host"), F.col("path"), queries.URL_RULES)
    known = pages.withColumn("blocked", (ruled == "block").cast("int")).where("blocked is not null")
    test = F.crc32(F.col("page_id").cast("string").cast("binary")) % 4 == 0
    out = urls.predict(known.where(test), urls.train(known.where(~test))).collect()
    right = sum((r["score"] > 0.5) == bool(r["blocked"]) for r in out)
    assert len(out) > 200 and right >= 0.97 * len(out)
    assert 0.2 < sum(r["blocked"] for r in out) / len(out) < 0.8


def test_url_filter_without_labels_or_rows(spark, url_pages):
    assert urls.filter_urls(url_pages.limit(0), queries.URL_RULES).count() == 0
    out = urls.filter_urls(url_pages, [], spark.createDataFrame([], "url string, blocked int")).select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in out] == [(None, "allow")]
    one = spark.createDataFrame([("http://a.com/", 1), ("http://b.net/", None)], "url string, blocked int")
    assert {r["verdict"] for r in urls.filter_urls(url_pages, [], one).collect()} == {"block"}


def test_url_filter_has_no_python_worker(spark):
    plan = queries.op11_url_filter(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


# --- op12 vector codes


def plain_codes(rows, parts, entries, rounds):
    """rows: (key, vector), any order; every round compares all with all in Python integers."""
    kept = [(k, [math.floor(1024 * x) for x in v]) for k, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    width = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == width]
    cuts = [width * i // parts for i in range(parts + 1)]
    books = [[v[a:b] for _, v in kept[:entries]] for a, b in zip(cuts, cuts[1:])]
    for step in range(rounds + 1):
        found = []
        for k, v in kept:
            near = [min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), i) for i, e in enumerate(book)) for (a, b), book in zip(zip(cuts, cuts[1:]), books)]
            found.append((k, [i for _, i in near], sum(d for d, _ in near)))
        if step == rounds:
            return found, books
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            groups = defaultdict(list)
            for (_, v), (_, c, _) in zip(kept, found):
                groups[c[p]].append(v[a:b])
            for e, members in groups.items():
                books[p][e] = [sum(col) // len(members) for col in zip(*members)]


def vector_rows():
    rng = random.Random(4)
    rows = [(i, [rng.randint(-3, 3) / 4 for _ in range(8)]) for i in range(120)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[5][1]), (200, None), (201, []), (202, [0.5] * 7 + [None]), (203, [0.5] * 7 + [float("nan")])]
    rows += [(204, [0.5] * 7 + [float("inf")]), (205, [0.25] * 9), (206, [-0.0001] * 8), (300, rows[3][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("entries, rounds", [(256, 4), (9, 4), (9, 0), (2, 3)])
def test_vector_codes_equal_brute_force(spark, entries, rounds):
    rows = vector_rows()
    labels = [[1, 2, None][i % 3] for i in range(len(rows))]
    df = spark.createDataFrame([(k, v, lab, 1, "x", [3]) for (k, v), lab in zip(rows, labels)], "vec_id long, embedding array<float>, label int, part int, n string, codes array<int>").repartition(4)
    got = veccodes.code_vectors(df, entries=entries, rounds=rounds).collect()
    found, books = plain_codes(rows, 4, entries, rounds)
    assert Counter((r["vec_id"], r["code"], r["error"]) for r in got) == Counter((k, "".join(f"{i:02x}" for i in c), d) for k, c, d in found)
    by_label = defaultdict(int)
    coded, got_books = veccodes.compress(df, entries=entries, rounds=rounds)
    for r in coded.collect():
        by_label[r["label"]] += sum(r["dists"])
    assert {r["label_error"] for r in got} == set(by_label.values())
    assert [e.tolist() for e in got_books.entries] == books


def test_active_entries_give_what_a_whole_scan_gives():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x, entries = rng.integers(-3, 4, (40, 3)), rng.integers(-3, 4, (9, 3))
        own, far = veccodes.assign(x, entries)
        after = entries.copy()
        moved = rng.random(9) < 0.4
        after[moved] += rng.integers(-1, 2, (int(moved.sum()), 3))
        moved = (after != entries).any(axis=1)
        for got, want in zip(veccodes.assign(x, after, moved, own, far), veccodes.assign(x, after)):
            assert got.tolist() == want.tolist()


def test_distances_are_exact_at_every_size():
    rng = random.Random(2)
    for size in (10, 10**7, 10**8, 10**9, 2**40):
        x = [[rng.randint(-size, size) for _ in range(4)] for _ in range(5)]
        e = [[rng.randint(-size, size) for _ in range(4)] for _ in range(3)]
        want = [[min(sum((a - b) ** 2 for a, b in zip(u, v)), 2**62) for v in e] for u in x]
        assert veccodes.squared_distances(np.array(x), np.array(e)).tolist() == want


def test_vector_codes_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert veccodes.code_vectors(spark.createDataFrame([], schema)).count() == 0
    assert veccodes.code_vectors(spark.createDataFrame([(1, None, 2)], schema)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    empty = veccodes.code_vectors(spark.createDataFrame([(1, [], 2), (2, [], None)], schema)).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in empty) == [(1, "00000000", 0), (2, "00000000", 0)]
    with pytest.raises(ValueError):
        veccodes.code_vectors(spark.createDataFrame([], schema), entries=257)


# --- op13 filter audit


def audit_rows():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    long_ = " ".join(words[:250])
    texts = [None, "", "  \n", long_, long_, long_ + " #", long_.upper(), "a " * 300, "é日 x", "A" * 1000, long_ + "\u0085x", "z" * 200_000, " ".join(words * 500)]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(190, 260))) + rng.choice(["", "", "%", " AB" * 40]) for _ in range(40)]
    rows = [(i, t, ["en", "fr", None, ""][i % 4]) for i, t in enumerate(texts)]
    return rows + [(3, long_, "en"), (3, long_, "en"), (3, "other", "en"), (None, long_, "fr"), (None, long_, "fr"), (100, texts[20], "de"), (101, texts[20], "de")]


def plain_audit(rows, good, toxic):
    first = {}
    for k, t, _ in rows:
        if k is not None:
            first[t or ""] = min(first.get(t or "", k), k)
    out = {}
    failed = defaultdict(list)
    for k, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        bad = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        bad["E"] = k is not None and first[t] < k
        failed[lang or ""].append(({x for x, y in bad.items() if y}, k in good, k in toxic))
    for part, docs in failed.items():
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            left = docs
            for i, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                redundant = sum(f in d[0] for d in docs) - len(gone)
                out[part, "".join(order), i + 1] = [len(left), len(gone), redundant, sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
                total[f] += len(gone)
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return out


def test_filter_audit_equals_brute_force(spark):
    rows = audit_rows()
    df = spark.createDataFrame([(*r, 1, "b", 3) for r in rows], "doc_id long, text string, lang string, bits int, h string, place int").repartition(5)
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (4, 0, 0), (9, None, 1), (None, 1, 1), (100, 1, None)], "doc_id long, quality int, toxic int")
    got = filteraudit.audit(df, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got.collect()} == plain_audit(rows, {1, 4, 100}, {4, 9})
    assert filteraudit.audit(df.limit(0), labels).count() == 0
    assert filteraudit.audit(df, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_filter_audit_with_a_third_of_the_rows_in_one_text(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 1, "copy").otherwise(F.concat(F.lit("t"), "id")).alias("text"), F.lit("en").alias("lang"))
    failed = filteraudit.failures(df.repartition(8)).where(F.col("bits").bitwiseAND(16) != 0).select("key").collect()
    assert {r["key"] for r in failed} == set(range(4, 6000, 3))


def test_other_filters_and_no_duplicate_filter(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "bb", None), (2, "bb", None)], "doc_id long, text string, lang string")
    short = {"S": lambda text, words: F.length(text) < 2}
    rows = filteraudit.failures(df, filters=short, duplicate=None).collect()
    assert sorted((r["key"], r["part"], r["bits"], r["n"]) for r in rows) == [(1, "", 1, 1), (2, "", 0, 2)]
    flags = filteraudit.label_flags(spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    out = filteraudit.interactions(filteraudit.failures(df, filters=short, duplicate=None), flags, "S").collect()
    assert [(r["filter_order"], r["kept"], r["removed"], r["shapley"]) for r in out] == [("S", 2, 1, 1)]


# --- long words and texts, names that clash, calibration, many languages


def long_texts():
    rng = random.Random(12)
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    base64 = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1_000_000))
    return {"letters": letters, "base64": base64, "mails": " ".join(f"a{i}@x.example.com 555-{i % 1000:03d}-{i % 10000:04d}" for i in range(28_000))}


@pytest.mark.parametrize("name", ["letters", "base64", "mails"])
def test_a_million_characters_in_one_text(name):
    """Each takes seconds: no step is quadratic in the length of a word or a text."""
    import time

    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from handover.llm import bpe, pii, toxicity

    text = long_texts()[name]
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec = bpe.codec(path)
    data = np.frombuffer(text.encode(), np.uint8)
    began = time.time()
    ids, off = codec.encode(pa.array([text]))
    toxicity.Voters([]).counts(data, np.array([0, len(data)]))
    _, spans = pii.pseudonymise(text, b"k")
    assert time.time() - began < 30
    assert codec.decode(ids, off).to_pylist() == [text]
    assert (len(spans) > 40_000) == (name == "mails")
    part = text[:100_000]
    assert codec.encode(pa.array([part]))[0].tolist() == Tokenizer.from_file(path).encode(part, add_special_tokens=False).ids


def test_masked_words_by_their_signs():
    from handover.llm import toxicity

    pattern = re.compile(r"[A-Za-z]+[*@#$]{2,}[A-Za-z]+")
    rng = random.Random(3)
    for _ in range(3000):
        word = "".join(rng.choice("ab1é*@#$") for _ in range(rng.randint(0, 9)))
        assert toxicity.masked(word) == (pattern.search(word) is not None), word


def test_margins_are_calibrated_on_labels():
    from handover.llm import toxicity

    rng = np.random.default_rng(5)
    margin = rng.normal(0, 3, 4000)
    label = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * margin - 1)))).astype(int)
    scale, shift = toxicity.calibrate(margin, label, np.ones(4000))
    assert abs(scale - 0.5) < 0.1 and abs(shift + 1) < 0.2
    assert toxicity.calibrate(margin, np.zeros(4000, int), np.ones(4000)) == (1.0, 0.0)
    scale, _ = toxicity.calibrate(margin, 1 - label, np.ones(4000))
    assert scale > 0  # the ranking is never turned round


def test_held_out_toxicity_at_the_threshold(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    held = queries.op6_toxicity(spark, sf).where("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in held)
    assert hit >= 0.75 * sum(r["toxic"] for r in held)
    assert hit >= 0.7 * sum(r["predicted"] for r in held)


def test_every_language_is_learned(spark, monkeypatch):
    from handover.llm import langid

    monkeypatch.setattr(langid, "SAMPLE_ROWS", 230 * 15)  # fewer than there are
    rng = random.Random(7)
    stems = {f"l{i:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(4)] for i in range(230)}
    rows = [(100 * i + j, " ".join(rng.choice(w) for _ in range(30)), lang) for i, (lang, w) in enumerate(stems.items()) for j in range(20)]
    out = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r["doc_id"]: r["lang_pred"] for r in out.collect()}
    assert len(set(got.values())) > 220  # a bound of 200 would show
    assert sum(got[k] == lang for k, _, lang in rows) > 0.9 * len(rows)


def test_columns_named_like_helpers_are_kept(spark):
    from handover.llm import decontam, linededup, quality

    names = ["__tag", "tag", "__row", "__gone", "__l", "__key", "__all", "__stratum", "stratum", "n_words", "kept", "h1", "a0", "th", "words"]
    text = "\n".join(" ".join(f"w{i}{j}" for j in range(9)) for i in range(9))
    rows = [(i, text + f" {i}", "en", *names) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    bench = spark.createDataFrame([(1, "nothing of it is in the texts above")], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    for out, n in ((decontam.remove_contaminated(df, bench), 3), (quality.filter_documents(df, labels), 3)):
        assert out.columns == df.columns
        assert [list(r)[3:] for r in out.collect()] == [names] * n
    cut = linededup.remove_repeated_lines(df)
    assert cut.columns == [*df.columns, "n_lines", "n_removed"]
    assert sorted((r["doc_id"], r["n_removed"]) for r in cut.collect()) == [(0, 0), (1, 8), (2, 8)]
    assert all(list(r)[3:-2] == names for r in cut.collect())


# --- op1: the mixer as a slow loop, and what it gains


def plain_mixer(model, symbols):
    """log10 probability of one text's decisions, one decision at a time; weights refined after every 64 words."""
    from handover.llm import lm

    c = model.coder
    w = {g: model.weights[g].astype(float).tolist() for g in range(8)}
    symbol = np.array(symbols)
    index, node, bit, *slots = c.word_events(symbol, np.arange(len(symbol)))
    total, pending, block = 0.0, [], 0
    for i, n, y, *s in zip(index.tolist(), node.tolist(), bit.tolist(), *(x.tolist() for x in slots)):
        if i // 64 != block:
            for g, step in pending:
                w[g] = [a + b for a, b in zip(w[g], step)]
            pending, block = [], i // 64
        seen = [int(model.tables[k][slot]) for k, slot in enumerate(s)]
        g = sum((v != 0) << k for k, v in enumerate(seen))
        x = [float(c.logit[n]), *(v / 16 for v in seen)]
        logit = sum(a * b for a, b in zip(w[g], x))
        total -= math.log10(1 + math.exp(max(-12.0, min(12.0, logit * (1 - 2 * y)))))
        p = 1 / (1 + math.exp(-max(-12.0, min(12.0, logit))))
        pending.append((g, [(y - p) * lm._RATE * v for v in x]))
    return total


def test_scores_equal_a_slow_mixer():
    from handover.llm import lm

    rng = np.random.default_rng(4)
    words = [(lm.END, 50), *((b"w%d" % i, int(1000 / (i + 1)) + 1) for i in range(60))]
    coder = lm.Coder(words, 30, bits=12)
    tables = rng.integers(-60, 61, (3, 1 << 12)).astype(np.int8)
    tables[rng.random(tables.shape) < 0.4] = 0  # contexts that weren't seen
    model = lm.Model(coder, tables)
    model.weights = rng.normal(0.3, 0.2, model.weights.shape).astype(np.float32)
    texts = [rng.integers(0, 62, n).tolist() for n in (1, 63, 64, 65, 700, 2)]
    symbol = np.array([s for t in texts for s in t])
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    place = np.concatenate([np.arange(len(t)) for t in texts])
    got = model.score(symbol, row, place, len(texts))
    assert np.allclose(got, [plain_mixer(model, t) for t in texts], rtol=1e-4)


def test_decisions_of_a_text_have_probability_one():
    """Over all words that may come next, the paths' probabilities add up to 1."""
    from handover.llm import lm

    rng = np.random.default_rng(9)
    coder = lm.Coder([(lm.END, 5), *((b"w%d" % i, i + 2) for i in range(30))], 4, bits=10)
    model = lm.Model(coder, rng.integers(-50, 51, (3, 1 << 10)).astype(np.int8))
    before = rng.integers(0, 31, 7).tolist()
    alone = model.score(np.array(before), np.zeros(7, int), np.arange(7), 1)[0]
    n = 32
    texts = np.array([[*before, s] for s in range(n)])
    scores = model.score(texts.ravel(), np.repeat(np.arange(n), 8), np.tile(np.arange(8), n), n)
    assert math.isclose(sum(10 ** (scores - alone)), 1, rel_tol=1e-4)


def test_counts_in_place_equal_counted_events():
    from handover.llm import lm

    rng = np.random.default_rng(2)
    counter = lm._Counter(8)
    want = np.zeros((3, 512), int)
    for _ in range(4):
        bit, slots = rng.integers(0, 2, 1000).astype(np.int8), rng.integers(0, 256, (3, 1000)).astype(np.uint32)
        counter.add((None, None, bit, *slots))
        for k in range(3):
            want[k] += np.bincount(2 * slots[k].astype(int) + bit, minlength=512)
    assert (counter.table == want).all()


def test_held_out_gain_over_the_base(spark):
    out = queries.op1_lm_scores(spark, "/root/testdata/sf0.01").groupBy("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).collect()
    for r in out:
        assert (r["s"] - r["b"]) / r["n"] > 0.5


def test_a_repeated_row_is_scored_as_often(spark):
    from handover.llm import lm

    rows = [(i, f"some words and some more {i % 7}") for i in range(40)] + [(7, "again and again")] * 50 + [(None, None)] * 3
    out = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(out) == len(rows)
    again = [tuple(r) for r in out if r["doc_id"] == 7 and r["n_tokens"] == 4]
    assert len(again) == 50 and len({(a[1:5], round(a[6], 9)) for a in again}) == 1
