"""The contracts in plain Python, one text at a time."""

import hashlib
import re

import xxhash


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def kept_words(docs, length=13):
    """(n_words, n_removed, kept words) of each (doc_id, text)."""
    first = {}
    for doc, text in docs:
        ws = words(text)
        for i in range(len(ws) - length + 1):
            key = tuple(ws[i : i + length])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text in docs:
        ws = words(text)
        gone = set()
        for i in range(len(ws) - length + 1):
            if doc is not None and first[tuple(ws[i : i + length])] < doc:
                gone.update(range(i, i + length))
        out.append((len(ws), len(gone), [w for i, w in enumerate(ws) if i not in gone]))
    return out


def fingerprint(text, k=3):
    ws = words(lower(text))
    grams = [" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)]
    grams = grams or ([" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def hits(docs, items, window=10):
    """(n_words, n_hit, sorted item ids) of each (doc_id, text)."""
    windows = {}
    for item, text in items:
        ws = terms(text)
        size = min(window, len(ws))
        for i in range(max(0, len(ws) - window) + 1 if ws else 0):
            windows.setdefault(tuple(ws[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for _, text in docs:
        ws, found, covered = terms(text), set(), set()
        for size in sizes:
            for i in range(len(ws) - size + 1):
                if items_hit := windows.get(tuple(ws[i : i + size])):
                    found |= items_hit
                    covered.update(range(i, i + size))
        out.append((len(ws), len(covered), sorted(str(i) for i in found if i is not None)))
    return out


def base_counts(text):
    text = text or ""
    ws = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(ws) - 2):
        places.setdefault(tuple(ws[i : i + 3]), []).append(i)
    covered = {p + j for ps in places.values() if len(ps) > 1 for p in ps for j in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(ws), sum(map(len, ws)), symbols, dup, len(covered)
