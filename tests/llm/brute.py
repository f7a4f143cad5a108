"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from tidepost.llm.sentences import MIN_SENTENCES, MIN_WORDS


def lines(docs):
    seen, out = {}, {}
    split = {i: t.split("\n") for i, t in docs}
    for i in sorted(split):
        for k in range(len(split[i]) - 2):
            seen.setdefault(tuple(split[i][k : k + 3]), (i, k))
    for i, ls in split.items():
        gone = set()
        for k in range(len(ls) - 2):
            window = tuple(ls[k : k + 3])
            if "".join(window).strip(" ") and seen[window] != (i, k):
                gone |= {k, k + 1, k + 2}
        out[i] = "\n".join(x for k, x in enumerate(ls) if k not in gone)
    return out


def sentences(docs):
    split = {i: re.findall(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+", t) for i, t in docs}
    spans, seen = defaultdict(list), {}
    for i in sorted(split):
        bare = [s.strip(" \t\n\r\x0b\x0c") for s in split[i]]
        count = [len(s.encode().split()) for s in bare]
        for k in range(len(bare)):
            end = k
            while end < len(bare) and (end - k < MIN_SENTENCES or sum(count[k:end]) < MIN_WORDS):
                end += 1
            if end - k >= MIN_SENTENCES and sum(count[k:end]) >= MIN_WORDS:
                span = tuple(bare[k:end])
                spans[i].append((k, end, span))
                seen.setdefault(span, (i, k))
    out = {}
    for i, parts in split.items():
        gone = {x for k, end, span in spans[i] if seen[span] != (i, k) for x in range(k, end)}
        out[i] = "".join(s for x, s in enumerate(parts) if x not in gone)
    return out


def substrings(docs, length=400):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        spans = []
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        kept, at = b"", 0
        for a, b in spans:
            kept += t[at:a]
            at = b
        kept += t[at:]
        out.append((str(i), len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)}


def components(docs):
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    ids = defaultdict(list)
    for (i, _), x in zip(docs, label, strict=True):
        ids[x] += [] if i is None else [i]
    return [(str(i), len(s), str(min(ids[x], default=None))) for (i, _), s, x in zip(docs, sets, label, strict=True)]


def check_packing(rows, docs, capacity):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for i, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.asarray(ids[at : at + capacity], "<u4")
            expected.append((str(i), piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r["length"] for r in rows) // capacity)
    assert len(places) <= least + 1 + len(rows) // 20


KINDS = ("email", "ip", "card", "phone")
PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def personal_base(text):
    """Counts by kind, spans, and the digest of base spans."""
    spans = []
    for rank, kind in enumerate(KINDS):
        spans += [(m.start(), rank, m.end()) for m in re.finditer(PERSONAL[kind], text or "") if passes(kind, m.group())]
    listed = ",".join(f"{KINDS[rank]}:{a}:{b}" for a, rank, b in sorted(spans))
    counts = Counter(KINDS[rank] for _, rank, _ in spans)
    return [counts[k] for k in KINDS], listed.split(",") if listed else [], hashlib.sha256(listed.encode()).hexdigest()


def language_model(rows, slots=1 << 14):
    """Log shares of hashed n-grams per language, from (text, lang)."""
    counts = defaultdict(Counter)
    for text, lang in rows:
        for n, found in enumerate(language_grams(text, slots)):
            counts[lang].update((n, g) for g in found)
    out = {}
    for lang, held in counts.items():
        total = [sum(v for (m, _), v in held.items() if m == n) + 0.5 * slots for n in range(3)]
        out[lang] = {(n, g): np.log((held[n, g] + 0.5) / total[n]) / 3 for n in range(3) for g in range(slots)}
    return out


def language_grams(text, slots):
    """For each n the slot of the n-gram that ends at each character, counted modulo 2**32."""
    codes = [ord(c) for c in " ".join(["", *text.lower().split(), ""])]
    held, out = [0] * len(codes), []
    for n, factor in enumerate((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)):
        held = [(h + (codes[k - n] if k >= n else 0) * factor) % 2**32 for k, h in enumerate(held)]
        out.append([((h ^ h >> 15) * 0x2C1B3C6D % 2**32) * slots >> 32 for h in held])
    return out


def language_of(text, model, slots=1 << 14):
    """The likeliest language of the best set of languages, sets grown one at a time, and its share."""
    if not any(c.isalpha() for c in text or "") or not model:
        return "und", 0.0
    names, grams = sorted(model), language_grams(text, slots)
    segments = [
        [sum(model[lang][n, grams[n][k]] for n in range(3) for k in range(a, min(a + 48, len(grams[0])))) for lang in names]
        for a in range(0, len(grams[0]), 48)
    ]

    def fitted(chosen):
        weight = {c: 1 / len(chosen) for c in chosen}
        tops = [max(s[c] for c in chosen) for s in segments]
        for _ in range(25 if len(chosen) > 1 else 0):
            sums = dict.fromkeys(chosen, 0.0)
            for s, top in zip(segments, tops, strict=True):
                parts = {c: weight[c] * np.exp(s[c] - top) for c in chosen}
                for c in chosen:
                    sums[c] += parts[c] / sum(parts.values())
            weight = {c: sums[c] / len(segments) for c in chosen}
        return weight, sum(np.log(sum(weight[c] * np.exp(s[c] - t) for c in chosen)) + t for s, t in zip(segments, tops, strict=True))

    everything = range(len(names))
    chosen = [max(everything, key=lambda c: (sum(s[c] for s in segments), -c))]
    (weight, best), penalty = fitted(chosen), 0.5 * np.log(len(segments) + 1) + 3
    while rest := [c for c in everything if c not in chosen]:
        gains = {c: sum(max(0, s[c] - max(s[k] for k in chosen)) for s in segments) for c in rest}
        grown = [*chosen, max(rest, key=lambda c: (gains[c], -c))]
        tried, value = fitted(grown)
        if gains[grown[-1]] <= penalty or value - best <= penalty:
            break
        chosen, weight, best = grown, tried, value
    first = max(weight, key=lambda c: (weight[c], -c))
    return names[first], weight[first]
