"""Plain, slow versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cover(items, window, repeated):
    mask = [False] * len(items)
    for i in range(len(items) - window + 1):
        if repeated(i):
            mask[i : i + window] = [True] * window
    return mask


def substring_dedup(rows, window=35):
    words = [WORD.findall(text or "") for _, text in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        mask = cover(w, window, lambda i, w=w: count[tuple(w[i : i + window])] > 1)
        kept = " ".join(x for x, m in zip(w, mask, strict=True) if not m)
        out.append((doc_id, len(w), sum(mask), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def suffix_array_dedup(rows, window=200):
    texts = [(text or "").encode() for _, text in rows]
    count = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        mask = cover(t, window, lambda i, t=t: count[t[i : i + window]] > 1)
        kept = bytes(x for x, m in zip(t, mask, strict=True) if not m)
        spans = sum(m and (i == 0 or not mask[i - 1]) for i, m in enumerate(mask))
        out.append((doc_id, len(t), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return out


LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def jaccard_join(rows, words=4, percent=85):
    """(doc_id, n_shingles, component_id) of every row."""
    sets = []
    for _, text in rows:
        found = WORD.findall((text or "").translate(LOWER))
        grams = {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}
        sets.append(grams or ({tuple(found)} if found else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [(doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows)]


def backoff_scores(rows, order=2, backoff=0.4, least=1):
    """(doc_id, n_words, log_score) of every row."""
    import math

    texts = [WORD.findall((text or "").translate(LOWER)) for _, text in rows]
    count = Counter(tuple(w[i : i + n]) for w in texts for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, texts))
    out = []
    for (doc_id, _), w in zip(rows, texts, strict=True):
        score = 0.0
        for i in range(len(w)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                gram = tuple(w[i - n + 1 : i + 1])
                if n == 1 or count[gram] >= least:
                    score += math.log(count[gram] / (count[gram[:-1]] if n > 1 else total))
                    score += (longest - n) * math.log(backoff)
                    break
        out.append((doc_id, len(w), score))
    return out


def edit_distance_within(item, text):
    """Fewest edits, in words, from the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def normal_words(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").translate(LOWER))


def edited_hash(rows):
    """(doc_id, n_chars, edited_sha256) for rows with distinct ids and texts."""
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        part = len(text) // 3
        changed = text[: len(text) - part] + after[:part]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    return out


def spelling_variants(rows, least_chars=5, least=3, every=97):
    """(word, form, root, n, n_near, form_n) of every word, by comparing all words with all."""
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            known = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and known % every == 0:
                at = known % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    words = sorted(w for w, n in count.items() if len(w) >= least_chars and n >= least)
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w in words:
        best = max(near[w], key=lambda v: (count[v], [-ord(c) for c in v] + [1]), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return out


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def byte_tokens(tokenizer, text):
    """(id, bytes) of every token of a byte-level tokenizer."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    found = tokenizer.encode(text, add_special_tokens=False)
    return [(i, bytes(byte[c] for c in x)) for i, x in zip(found.ids, found.tokens, strict=True)]


def piece_tokens(model, text):
    """(id, bytes) of every piece of a sentencepiece model."""
    out = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", piece) if model.is_byte(i) else None
        out.append((i, bytes.fromhex(byte[1]) if byte else piece.replace("▁", " ").encode()))
    return out


def alignment(rows, path_a, path_b):
    """The rows of the query over whole texts, with a group at each byte where both tokenizers end."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(path_a)
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=path_b)
    found = []
    for _, text in rows:
        groups = []
        if text:
            a, b, whole = byte_tokens(first, " " + text), piece_tokens(second, text), (" " + text).encode()
            if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                groups = common_groups(a, b)
        found.append(groups)
    count = Counter(p for groups in found for p in {(x, y) for a, b in groups for x in a for y in b})
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for (doc_id, _), groups in zip(rows, found, strict=True):
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return out


def common_groups(a, b):
    groups, one, two, ends = [], [], [], [0, 0]
    a, b = list(a), list(b)
    while a or b:
        side = 0 if ends[0] <= ends[1] else 1
        i, data = (a, b)[side].pop(0)
        (one, two)[side].append(i)
        ends[side] += len(data)
        if ends[0] == ends[1]:
            groups.append((one, two))
            one, two = [], []
    return groups


def line_dedup(rows, least=24):
    """Numbers of lines (not blank ones) covered by blocks of at least ``least`` characters that an earlier row holds too; no line repeats in a row."""
    texts = [text.split("\n") for _, text in rows]
    out = []
    for later, own in enumerate(texts):
        gone = set()
        for first in texts[:later]:
            place = {x: i for i, x in enumerate(first)}
            j = 0
            while j < len(own):
                end = j
                while end < len(own) and own[end] in place and place[own[end]] == place[own[j]] + end - j:
                    end += 1
                if sum(map(len, own[j:end])) >= least:
                    gone |= set(range(j, end))
                j = max(end, j + 1)
        out.append(gone)
    return out
