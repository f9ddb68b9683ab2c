"""Brute-force versions of the registered queries, on plain Python lists of rows."""

import hashlib
import math
import re
import zlib
from difflib import SequenceMatcher

ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items):
    windows = []
    for item, text in items:
        words = ITEM.findall(lower(text))
        n = min(13, len(words))
        windows += [(str(item), tuple(words[k : k + n])) for k in range(len(words) - n + 1) if n]
    out = {}
    for doc, text in docs:
        words, hit, met = ITEM.findall(lower(text)), set(), set()
        for item, w in windows:
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    met.add(item)
        out[doc] = (len(words), len(hit), len(met), sha(",".join(sorted(met))), len(hit) > 0 and 20 * len(hit) >= len(words))
    return out


def tokens(docs, tokenizer):
    out, start = {}, 0
    for doc, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        out[doc] = (start, len(ids), zlib.crc32(raw))
        start += len(ids)
    return out


def base_pii(text):
    def luhn(s):
        d = [int(c) for c in s if c.isdigit()]
        total = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        return 12 <= len(d) <= 19 and total % 10 == 0

    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", luhn),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= sum(c.isdigit() for c in s) <= 15),
    }
    found = []
    for rank, (kind, (pattern, ok)) in enumerate(kinds.items()):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if ok(m[0])]
    found.sort()
    counts = [sum(f[2] == k for f in found) for k in kinds]
    return (*counts, sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in found)))


def rule_counts(text):
    text = text or ""
    words = PLAIN.findall(text)
    lines = [x for x in text.split("\n") if PLAIN.search(x)]
    grams = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    seen = {}
    for k, g in enumerate(grams):
        seen.setdefault(g, []).append(k)
    covered = {p for places in seen.values() if len(places) > 1 for k in places for p in range(k, k + 8)}
    n = len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def rule_verdicts(rows, *, min_group, tail, fence):
    """{doc_id: (base_failed, kept)}; a quantile is the value at the rounded-up rank of the sorted group."""
    stats, groups = {}, {}
    for doc, text, lang, source in rows:
        n, chars, symbols, dups, repeats, failed = rule_counts(text)
        words, lines = max(n, 1), max(sum(1 for x in (text or "").split("\n") if PLAIN.search(x)), 1)
        shares = (symbols / words, dups / lines, chars / words, repeats / words)
        stats[doc] = (shares, (1 / words, 1 / lines, 1 / words, 30 / words), lang, source, failed)
        if not failed:
            for group in ((lang, source), (lang,), ()):
                groups.setdefault(group, []).append(shares)
    out = {}
    for doc, (shares, grains, lang, source, failed) in stats.items():
        inside = True
        for at, (x, grain) in enumerate(zip(shares, grains, strict=True)):
            fitting = [g for g in ((lang, source), (lang,)) if len(groups.get(g, ())) >= min_group]
            # A source all of whose documents fail has no fences.
            if (lang, source) not in groups:
                break
            values = sorted(v[at] for v in groups[(fitting or [()])[0]])
            low, mid, high = (values[max(math.ceil(q * len(values)), 1) - 1] for q in (tail, 0.5, 1 - tail))
            inside &= x <= high + fence * (high - mid) + grain
            if at == 2:
                inside &= x >= low - fence * (mid - low) - grain
        out[doc] = (failed, not failed and inside)
    return out


def chats(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    return out


def license_places(text):
    words = ITEM.findall(lower(text))
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    found = [(k, label) for label, p in phrases.items() for k in range(len(words)) if words[k : k + len(p)] == p]
    starts = [k for k, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


def notice_labels(text, notices):
    """Labels of notices of which 0.6 stands in order, in runs of two words or more, in some stretch of three lengths."""
    words, labels = ITEM.findall(lower(text)), set()
    for label, texts in notices.items():
        for notice in texts:
            known = ITEM.findall(lower(notice))
            for at in range(0, max(len(words) - 2 * len(known), 1), len(known) // 4):
                part = words[at : at + 3 * len(known)]
                blocks = SequenceMatcher(None, part, known, autojunk=False).get_matching_blocks()
                if sum(b.size for b in blocks if b.size > 1) >= 0.6 * len(known):
                    labels.add(label)
    return ",".join(sorted(labels))


def shingles(text):
    words = PLAIN.findall(lower(text))
    if len(words) < 2:
        return {tuple(words)} if words else set()
    return set(zip(words, words[1:], strict=False))


def near_groups(docs):
    sets = {doc: shingles(text) for doc, text in docs}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}
