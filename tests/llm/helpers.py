"""Plain versions of what the operators compute."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, extra=False):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "'x' AS key", "1 AS id", "2 AS node", "'y' AS base", "3 AS stratum") if extra else df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, n):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < n else frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def groups(texts, n, percent):
    """Smallest index reachable by links, for each text."""
    sets = [shingle_set(t, n) for t in texts]
    comp = list(range(len(texts)))
    for j in range(len(sets)):
        for i in range(j):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((comp[i], comp[j]))
                comp = [a if c == b else c for c in comp]
    return comp


def base_secrets(text):
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_pii(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return sorted(out + [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15])


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
