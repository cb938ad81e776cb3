"""Plain-Python versions of the operators' contracts, and small tables with awkward rows."""

from __future__ import annotations

import hashlib
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Table of (doc_id, text[, source]) rows; n_chars and lang are filled in."""
    full = [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")) for row in rows]
    return spark.createDataFrame(full, DOCS)


def write_tables(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()][::-1]
        luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits))
        if 13 <= len(digits) <= 19 and luhn % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


_ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)


def base_secrets(text):
    text, out = text or "", []
    for m in _ASSIGN.finditer(text):
        if len(m.group(2)) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 18:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m.group()) >= 16:
            out.append((m.start(), 2, "hex", m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def dedup_components(rows, percent=85):
    """component of every (doc_id, text) row by comparing all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        members.setdefault(root(i), []).append(doc_id)
    return [min(members[root(i)]) for i in range(len(rows))]
