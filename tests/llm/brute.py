"""Plain versions of the corpus operators, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

from pedalpath.llm import decontaminate, quality

SPACE = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base_quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = text.split("\n")
    again = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def quality_stage(rows):
    out = []
    for r in rows:
        found = quality.judge((r["text"] or "").encode())
        if found["kept"]:
            text = found["cleaned"].decode()
            out.append({**r, "text": text, "n_chars": len(text) if found["lines_lost"] else r["n_chars"]})
    return out


def _key(r):
    return r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""


def line_cuts(rows, min_lines=2, min_words=20, line_words=None):
    """Per different (doc_id, text): the ranges of lines that go."""
    lines, places, alone = {}, defaultdict(set), defaultdict(set)
    for key in {_key(r) for r in rows}:
        solid = [(i, x.strip(SPACE)) for i, x in enumerate(key[2].split("\n")) if x.strip(SPACE)]
        lines[key] = solid
        for p in range(len(solid) - min_lines + 1):
            places[tuple(x for _, x in solid[p:p + min_lines])].add((key, p))
        for p, (_, x) in enumerate(solid):
            if line_words is not None and len(WORD.findall(x)) >= line_words:
                alone[x].add((key, p))
    cuts = {}
    covered = defaultdict(set)
    for width, table in ((min_lines, places), (1, alone)):
        for found in table.values():
            # equal numbers with unequal texts are ordered by a hash of the text; such ties are for the caller to avoid
            for key, p in sorted(found)[1:]:
                covered[key] |= set(range(p, p + width))
    for key, hit in covered.items():
        run, ranges = [], []
        for p in [*sorted(hit), None]:
            if run and (p is None or p != run[-1] + 1):
                if sum(len(WORD.findall(lines[key][q][1])) for q in run) >= min_words:
                    ranges.append((lines[key][run[0]][0], lines[key][run[-1]][0]))
                run = []
            run.append(p)
        cuts[key] = ranges
    return {k: v for k, v in cuts.items() if v}


def line_stage(rows, **rules):
    cuts, out = line_cuts(rows, **rules), []
    for r in rows:
        gone = {i for a, b in cuts.get(_key(r), ()) for i in range(a, b + 1)}
        if not gone:
            out.append(r)
            continue
        text = "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone)
        if text.strip(SPACE):
            out.append({**r, "text": text, "n_chars": len(text)})
    return out


def shingles(text):
    words = WORD.findall(lower(text))
    return frozenset(zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def components(rows):
    """{doc_id: (set of sizes, smallest doc_id reachable)}."""
    sets = [(r["doc_id"], shingles(r["text"])) for r in rows if r["doc_id"] is not None]
    up = {d: d for d, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                up[max(top(a), top(b))] = min(top(a), top(b))
    return {d: top(d) for d in up}


def near_stage(rows):
    found, seen, out = components(rows), set(), []
    for r in rows:
        if r["doc_id"] is None or (found[r["doc_id"]] == r["doc_id"] and r["doc_id"] not in seen):
            seen.add(r["doc_id"])
            out.append(r)
    return out


def leaked(text, items, rules=decontaminate.DEFAULT):
    """Items of which enough windows stand in the text, on diagonals with consistent slots."""
    templates = decontaminate.Templates()
    h, _, tokens = templates.of((text or "").encode())
    h = h.tolist()
    out = set()
    for number, item in items:
        ih, ikind, itokens = templates.of((item or "").encode())
        ih = ih.tolist()
        size = min(rules.window, len(ih))
        if size < rules.shortest:
            continue
        wanted = [p for p in range(len(ih) - size + 1) if sum(x == decontaminate.WORD for x in ikind[p:p + size]) > rules.plain * size]
        places = defaultdict(list)
        for q in range(len(h) - size + 1):
            places[tuple(h[q:q + size])].append(q)
        diagonals = defaultdict(list)
        for p in wanted:
            for q in places.get(tuple(ih[p:p + size]), ()):
                diagonals[q - p].append(p)
        matched = set()
        for d, hits in diagonals.items():
            values = defaultdict(set)
            for p in hits:
                for q in range(p, p + size):
                    if ikind[q] != decontaminate.WORD:
                        values[ikind[q], itokens[q].lower()].add(tokens[q + d].lower())
            if all(len(v) == 1 for v in values.values()):
                matched |= set(hits)
        if matched and len(matched) >= min(rules.enough, math.ceil(len(wanted) * rules.share)):
            out.add(number)
    return out


def mixture(rows, weights=(5, 2, 1), epochs=3, seed="mix-1"):
    """(size, source_size, target, times) per row."""
    size = [len(WORD.findall(r["text"] or "")) for r in rows]
    names = sorted({r["source"] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    whole = {s: sum(n for n, r in zip(size, rows) if r["source"] == s) for s in names}
    capped = set()
    while True:
        free = sum(whole.values()) - sum(epochs * whole[s] for s in capped)
        held = sum(w for s, w in weight.items() if s not in capped)
        target = {s: epochs * whole[s] if s in capped else weight[s] * free / held for s in names}
        over = {s for s in names if target[s] > epochs * whole[s]}
        if not over:
            break
        capped |= over
    place = [hashlib.md5(f"{seed}|{'' if r['doc_id'] is None else r['doc_id']}|{r['text'] or ''}".encode()).hexdigest()[:12] for r in rows]
    out = [None] * len(rows)
    for s in names:
        own = [i for i, r in enumerate(rows) if r["source"] == s]
        times = int(target[s] // whole[s]) if whole[s] else 0
        rest, more = target[s] - times * whole[s], set()
        for p in sorted({place[i] for i in own}):
            unit = sorted((i for i in own if place[i] == p), key=lambda i: size[i])
            words = sum(size[i] for i in unit)
            if rest <= 0:
                break
            if words <= rest:
                more |= set(unit)
                rest -= words
                continue
            for i in unit:
                if size[i] and 2 * rest >= size[i]:
                    more.add(i)
                rest -= size[i]
            break
        for i in own:
            out[i] = size[i], whole[s], target[s], times + (i in more)
    return out
