"""Corpus operators against plain versions, on a table with every kind of odd row."""

import hashlib
import math
import random
import re

import pytest

from pedalpath.llm import (chat_format, decontaminate, licenses, line_dedup, mixing, ngram_join, quality, span_dedup, toxicity,
                           url_filter)
from pedalpath.llm.common import Scratch
from . import brute

#: columns after ``n_chars`` have the names of columns that operators use inside
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, sig string, h string, "
          "node string, text_left string, repetition string, place string")
VOCABULARY = [a + b for a in ("ta", "no", "re", "mi", "lu", "so") for b in ("k", "lan", "ver", "ti", "po", "gra", "n")]


def prose(rng, n, line=12):
    words = [rng.choice(VOCABULARY) + rng.choice("aeiou") * rng.randint(0, 2) for _ in range(n)]
    out = []
    for i in range(0, n, line):
        part = words[i:i + line]
        cut = len(part) // 2
        out.append(" ".join(part[:cut]).capitalize() + ". " + " ".join(part[cut:]).capitalize() + ".")
    return "\n".join(out)


def make_rows():
    rng = random.Random(7)
    base = [prose(rng, n) for n in (60, 90, 150, 400, 40, 75)]
    passage = ". ".join(prose(rng, 60).replace("\n", " ").split(". "))
    texts = list(base)
    texts += [base[0], base[0], base[2] + " Extra words here.", base[2].replace(" ", "  ")]
    words = base[3].split(" ")
    for k in range(3):  # near copies
        changed = list(words)
        changed[20 + 40 * k] = "different"
        texts.append(" ".join(changed))
    texts += [prose(rng, 80) + "\n" + passage + "\n" + prose(rng, 60) for _ in range(3)]
    texts += ["", " \n\t ", None, "one two", "one two", "x" * 300_000, "word " * 3_000, "ÀÉ ñandú 漢字 " * 30]
    texts += ["| a | b | c | d |\nRead more\n" + base[5], base[1].upper(), "Licensed under CC BY-NC 4.0.\n" + prose(rng, 55)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, base[3]), (6, base[0]), (None, base[1]), (None, None)]
    return [{"doc_id": d, "text": t, "lang": "en" if d else None, "source": [None, "b", "a", "é"][(d or 0) % 4],
             "n_chars": len(t) if t is not None else None, "size": 1, "sig": "s", "h": None, "node": "n", "text_left": "t",
             "repetition": "r", "place": "p"} for d, t in rows]


ROWS = make_rows()


def frame(spark, rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS)


def same_rows(df, rows):
    """Rows of ``df`` against dicts, whatever their order."""
    mine = sorted((tuple(r) for r in df.collect()), key=repr)
    assert mine == sorted((tuple(r[c] for c in df.columns) for r in rows), key=repr)


ITEMS = [(0, "How many crates does Anna load when she moves 12 boxes of 30 kg each from Berlin to the harbour in 4 days"), (1, None),
         (2, "short one"), (3, ""), (3, "")]


EMPTY = {
    "quality": quality.quality_report, "clean": quality.clean_documents, "mix": mixing.mix_report, "mixed": mixing.mix_documents,
    "sets": ngram_join.similar_sets, "one": ngram_join.one_per_component, "lines": line_dedup.dedup_report,
    "no lines": line_dedup.drop_repeated_lines, "spans": span_dedup.dedup_report, "no spans": span_dedup.without_repeats,
    "licences": licenses.licence_scan,
    "leaks": lambda d: decontaminate.leaks(d, d.sparkSession.createDataFrame(ITEMS, "item_id long, text string")),
    "no leaks": lambda d: decontaminate.without_leaks(d, d.sparkSession.createDataFrame([], "item_id long, text string")),
    "toxicity": lambda d: toxicity.score_documents(d, toxicity.train(d, d.sparkSession.createDataFrame([], "doc_id long, toxic int"))),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_table(spark, name):
    assert EMPTY[name](frame(spark, [])).collect() == []


def test_quality(docs):
    found = quality.quality_report(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    names = found.columns
    same_rows(found, [dict(zip(names, (r["doc_id"], *brute.base_quality(r["text"])))) for r in ROWS])
    kept = quality.clean_documents(docs)
    assert kept.columns == docs.columns
    same_rows(kept, brute.quality_stage(ROWS))


def test_line_rules():
    fails = lambda line: quality.line_fails(line.encode(), line.encode().split())
    assert fails("Home | News | Sport | Weather") == "navigation"
    assert fails("And&&& a$$$ third%%% one###") == "symbols"
    assert fails("Click here to win") == "boilerplate"
    assert fails("go go go go go go go now") == "repeats"
    assert fails("THIS IS SHOUTED AT THE READER FOR LONG") == "capitals"
    assert fails("win!! big!! now!! here!!") == "exclamations"
    assert fails("A plain sentence, with $5 in it and nothing odd.") is None


def test_mix(docs):
    found = mixing.mix_report(docs).collect()
    wanted = brute.mixture(ROWS)
    assert sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in found), key=repr) == sorted(
        ((r["doc_id"], n, whole, round(t, 6), n * k) for r, (n, whole, t, k) in zip(ROWS, wanted)), key=repr)
    rows = mixing.mix_documents(docs)
    assert rows.columns == [*docs.columns, "_repetition"]
    assert rows.count() == sum(k for *_, k in wanted)


def test_similar_sets(docs):
    wanted = brute.components(ROWS)
    same_rows(ngram_join.similar_sets(docs), [
        {"doc_id": r["doc_id"], "n_shingles": len(brute.shingles(r["text"])), "component_id": wanted.get(r["doc_id"])} for r in ROWS])
    kept = ngram_join.one_per_component(docs)
    assert kept.columns == docs.columns
    same_rows(kept, brute.near_stage(ROWS))


def test_similar_sets_chain(spark):
    """Links through a chain of texts that are not alike at its ends, and texts just below the limit."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(12):
        texts.append(" ".join(words))
        words[7 * k + 3] = f"new{k}"
    texts += [" ".join(rng.sample([f"v{i}" for i in range(400)], 60)) for _ in range(10)]
    rows = [{"doc_id": 100 - i, "text": t} for i, t in enumerate(texts)]
    found = ngram_join.similar_sets(spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string"))
    wanted = brute.components(rows)
    assert {r.doc_id: r.component_id for r in found.collect()} == wanted
    assert len(set(wanted.values())) < len(rows)


def test_lines(docs):
    found = line_dedup.dedup_report(docs).collect()
    wanted = brute.line_cuts(ROWS)
    assert sorted(((r.doc_id, r.first_line, r.last_line) for r in found), key=repr) == sorted(
        ((None if none else d, a, b) for (none, d, _), v in wanted.items() for a, b in v), key=repr)
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns
    same_rows(left, brute.line_stage(ROWS))


def test_common_lengths(spark):
    """The longest common length against a comparison of all suffixes."""
    rng = random.Random(5)
    texts = {i: [f"line number {rng.randint(0, 3)} of a text with several words" for _ in range(rng.randint(1, 9))] for i in range(8)}
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in texts.items()], "doc_id long, text string")
    with Scratch(spark, "lines") as scratch:
        array, levels = line_dedup.suffix_array(line_dedup.line_numbers(df).cache(), scratch)
        found = {(r.doc, r.pos): r.lcp for r in line_dedup.common_lengths(array, levels, scratch).collect()}
    suffixes = [(tuple(x[p:]), i, p) for i, x in texts.items() for p in range(len(x))]
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    longest = {(i, p): max(common(s, t) for t, j, q in suffixes if (i, p) != (j, q)) for s, i, p in suffixes}
    assert set(found) == {k for k, n in longest.items() if n >= 2}
    # the first of a class has 0; its neighbour behind it has their common length
    assert max(found.values()) == max(longest.values())
    assert all(found[k] <= longest[k] for k in found)


def test_spans(docs, spark):
    """A run goes wherever it is not the first of its words; text outside such runs stays byte for byte."""
    first, cuts = {}, {}
    order = sorted({brute._key(r) for r in ROWS})
    for key in order:
        _, words = span_dedup.sentences(key[2].encode())
        for a, b in span_dedup.runs(words):
            first.setdefault(b" ".join(w for s in words[a:b + 1] for w in s), (key, a))
    for key in order:
        _, words = span_dedup.sentences(key[2].encode())
        hit = set()
        for a, b in span_dedup.runs(words):
            if first[b" ".join(w for s in words[a:b + 1] for w in s)] != (key, a):
                hit |= set(range(a, b + 1))
        cuts[key] = hit
    found = {(r.doc_id, r.n_sentences) for r in span_dedup.dedup_report(docs).collect()}
    assert found == {(None if none else d, len(cuts[none, d, t])) for none, d, t in order if cuts[none, d, t]}
    left = {(r.doc_id, r.text) for r in span_dedup.without_repeats(docs).collect()}
    clean = {(None if k[0] else k[1], k[2]) for k in order if not cuts[k]}
    assert {(d, t or "") for d, t in left} >= {x for x in clean if x[1].strip()}


def test_planted_passages(spark):
    rng = random.Random(11)
    passages = [" ".join(prose(rng, n, line).replace("\n", " ").split()) for n, line in ((55, 12), (60, 60), (80, 30), (51, 102))]
    rows, clean = [], set()
    for i in range(40):
        text = prose(rng, 120)
        if i < 24:
            text = text + "\n" + passages[i % 4] + "\n" + prose(rng, 50)
        else:
            clean.add(i)
        rows.append((i, text))
    found = span_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(4, 24))
    for r in found:
        assert r.first_doc_ids == [r.doc_id % 4] and passages[r.doc_id % 4] not in r.text_left


def test_leaks(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    told = "Before it. How many crates does Eva load when she moves 75 boxes of 8 lb each from Paris to the harbour in 9 days? After it."
    mixed = ("Well. How many crates does Eva load when she moves 75 boxes of 8 lb each from Paris to the harbour in 9 days and then "
             "how many of the crates does Tom load")
    other = "How many crates are there in the harbour of Berlin, and who moves the boxes that Anna left there for days"
    rows = spark.createDataFrame([(1, told), (2, mixed), (3, other), (4, ITEMS[0][1].upper()), (5, None), (None, told)], "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.changed for r in decontaminate.leaks(rows, items).collect()}
    assert found == {(1, 0): True, (2, 0): True, (None, 0): True, **({(4, 0): False} if (4, 0) in found else {})}
    assert {r.doc_id for r in decontaminate.without_leaks(rows, items).collect()} >= {3, 5}
    wanted = {(r["doc_id"], i) for r in ROWS for i in brute.leaked(r["text"], ITEMS)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()} == wanted


def test_slots_must_agree(spark):
    """One number of the item may not stand for two in the document."""
    item = "the first box holds 12 red marbles and the second box holds 12 green marbles in all"
    same = item.replace("12", "40")
    differ = item.replace("12", "40", 1).replace("12", "50")
    items = spark.createDataFrame([(0, item)], "item_id long, text string")
    rows = spark.createDataFrame([(1, same), (2, differ)], "doc_id long, text string")
    assert {r.doc_id for r in decontaminate.leaks(rows, items).collect()} == {1}


def test_licences(docs):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    for r in licenses.licence_scan(docs).collect():
        text = next(x["text"] for x in ROWS if x["doc_id"] == r.doc_id and (
            r.doc_id is not None or len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(x["text"]))) == r.n_words))
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text))
        at = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({x for _, x in at})))
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(","))


def test_licence_labels(spark):
    texts = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.\nAll  rights, RESERVED. all rights reserved",
             "This work is licensed under the GNU General Public License, version 3.", "the mit has no license", "cc cc by by", None]
    rows = {r.doc_id: r for r in licenses.licence_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[i].labels for i in range(6)] == ["mit", "cc-by,cc-by-nc,reserved", "gpl,gpl-3", "", "cc-by", ""]
    assert (rows[1].n_base, rows[1].first_word, rows[1].last_word) == (3, 2, 10)


PAGES = [
    (0, "http://a.net/en/1", None), (1, "https://X.Example.NET/en/2?q=http://b.org/", "<a href='http://friend.org/x'>"),
    (2, "http://bad.example.com/de/", '<a href="//hub.org/fr/1">'), (3, "http://bad.example.com/fr/9#top", ""), (4, "http://hub.org/fr/3", None),
    (5, "http://org", None), (6, "no scheme", "<a href=http://x.org>"), (7, None, None), (8, "http://friend.org/es", '<A HREF="http://hub.org">'),
    (8, "http://friend.org/es", '<A HREF="http://hub.org">'), (9, "http://notnet/", None), (10, "http://net/", None),
    (11, "http://feeds.bad.com/q", "<a href=http://bad.example.com/de/1>"), (12, "x://example.net/en/a", None), (13, "http://hub.org?x=/fr/", None)]


def test_urls(spark):
    found = url_filter.judge_urls(spark.createDataFrame(PAGES, "page_id long, url string, html string")).collect()
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    wanted = []
    for page, url, _ in PAGES:
        host = path = ""
        if url and "://" in url:
            rest = url[url.index("://") + 3:]
            host = re.split(r"[/?#]", rest, maxsplit=1)[0]
            path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
            host = brute.lower(host)
        fit = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        wanted.append((page, host, path, *(max(fit, key=lambda x: len(x[0])) if fit else (None, None))))
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in found), key=repr) == sorted((w[:4] for w in wanted), key=repr)
    said = {w[0]: w[4] for w in wanted}
    assert all(r.verdict == said[r.page_id] for r in found if said[r.page_id])
    verdict = {r.page_id: r.verdict for r in found}
    # the host of blocked pages is blocked; one that trusted pages know is not
    assert (verdict[3], verdict[8], verdict[13], verdict[7]) == ("block", "allow", "allow", "allow")


def test_propagation(spark):
    """Scores against power iteration."""
    edges = [("a", "b", 2.0), ("b", "c", 1.0), ("c", "a", 1.0), ("a", "c", 1.0), ("d", "c", 3.0), ("e", "d", 1.0)]
    seeds = {"a": (1.0, 0.0), "c": (0.0, 0.75), "b": (0.0, 0.25)}
    spread = url_filter.Spread(rounds=12, settled=0.0)
    found = {r.host: (r.trust, r.distrust) for r in url_filter.propagate(
        spark.createDataFrame(edges, "a string, b string, weight double"),
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust double, distrust double"), spread).collect()}
    out, into = {}, {}
    for a, b, w in edges:
        out[a], into[b] = out.get(a, 0) + w, into.get(b, 0) + w
    now = {h: list(seeds.get(h, (0, 0))) for h in "abcde"}
    for _ in range(12):
        after = {h: [0.15 * x for x in seeds.get(h, (0, 0))] for h in "abcde"}
        for a, b, w in edges:
            after[b][0] += 0.85 * now[a][0] * w / out[a]
            after[a][1] += 0.85 * now[b][1] * w / into[b]
        now = after
    for h, (t, d) in now.items():
        assert math.isclose(found.get(h, (0, 0))[0], t, abs_tol=1e-9) and math.isclose(found.get(h, (0, 0))[1], d, abs_tol=1e-9)


def test_grammar():
    grammar = toxicity.Grammar({"=moron": 2.0, "pathe": 1.5})
    plain, aimed = grammar.features(b"The moron went home."), grammar.features(b"You are a moron.")
    assert plain[0] > 0 and aimed[0] == 0 and aimed[1] > 0
    assert grammar.features(b"He is not a moron.")[2] > 0
    assert grammar.features("She said: a pathetic try.".encode())[3] > 0
    assert not any(grammar.features(b"I kill time. We beat eggs.")) and grammar.features(b"I will find you and kill")[1] > 0
    assert not any(grammar.features(b"")) and not any(grammar.features(b"not you said"))


def test_toxicity_held_out(spark):
    """Accuracy on the third that is never read, and that its labels change nothing."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity._third(toxicity.F.col("doc_id")) == 1, 1 - toxicity.F.col("toxic"))
                                .otherwise(toxicity.F.col("toxic")))
    assert toxicity.train(docs, flipped) == model
    rows = toxicity.score_documents(docs, model).join(labels, "doc_id").where("held_out").select("score", "toxic", "predicted").collect()
    good, bad = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert auc > 0.95
    hit = [r.toxic for r in rows if r.predicted]
    assert sum(hit) / len(hit) > 0.9 and sum(hit) / len(good) > 0.75


def test_toxicity_odd_rows(docs, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity.score_documents(docs, toxicity.train(docs, labels)).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)


TURNS = [
    (1, 0, "user", "Hello <|im_end|> there"), (1, 1, "assistant", "\n\n  Hi <\\|im_start|> <|endoftext|> \U0001F600 é\n"), (1, 2, "assistant", "again"),
    (2, 0, "system", None), (2, 1, "assistant", ""), (2, 2, None, "no role"), (2, None, "assistant", "first"), (3, 0, "assistant", "<|im_sep|>"),
    (3, 0, "assistant", "<|im_sep|>"), (None, 1, "assistant", "x"), (4, 0, "user", "only"), (5, 0, "assistant", "long words here " * 5_000),
    (5, 1, "user", "ok"), (5, 2, "assistant", "<" + "\\" * 5 + "|")]


@pytest.mark.parametrize("part", [400_000, 10])
def test_chat_round_trip(spark, part):
    fmt = chat_format.ChatFormat(part_chars=part)
    rows = spark.createDataFrame([(*t, "extra", "extra") for t in TURNS], "conv_id long, turn long, role string, text string, part string, input_ids string")
    found = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(rows, fmt), fmt).collect()}
    wanted = {}
    for c, turn, role, text in sorted(TURNS, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        wanted.setdefault(c, []).append((role or "", text or ""))
    assert set(found) == set(wanted)
    for c, turns in wanted.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = found[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), digest("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), digest(loss))
        assert r.formatted_chars == sum(len(chat_format.START + chat_format.escape(a) + chat_format.SEP + chat_format.escape(b) + chat_format.END)
                                        for a, b in turns)


def test_chat_empty(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digests(chat_format.format_conversations(rows)).collect() == []
