"""Base entities against plain regular expressions; bootstrapping against a plain computation."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from llm_cases import SCHEMA, cases, row

from quarry.llm import personal

SMALL = "/root/testdata/sf0.001"
KINDS = personal.KINDS


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m.group().split("."))) <= 255]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == 3 or luhn(digits)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower().replace(b":", b": ").replace(b"=", b"= "))


def lexical(word):
    return not re.search(rb"[0-9@]", word) and re.search(rb"[a-z\x80-\xff]", word)


def plain(texts):
    """Spans of each text, by the docstring's rules on plain dictionaries."""
    finder, per_text, edges, totals = personal.Finder(), [], defaultdict(Counter), Counter()
    for text in texts:
        spans, met = base(text), []
        for a, b, kind in [(a, b, k) for a, k, b in spans] + [(a, b, None) for a, b in finder.candidates(text, spans)]:
            words = words_of(text[:a].rstrip(personal.OPENING))
            if words and lexical(words[-1]):
                contexts = [(words[-1],)] + ([tuple(words[-2:])] if len(words) > 1 and lexical(words[-2]) else [])
                met.append((a, b, kind, contexts))
                for c in contexts:
                    edges[c][text[a:b].encode().lower(), kind] += 1
        words = words_of(text)
        totals.update((w,) for w in words[:-1])
        totals.update(zip(words[:-2], words[1:-1]))
        per_text.append((spans, met))
    edges = {c: e for c, e in edges.items() if len(e) >= 3}
    known = {i: (k, 1.0) for e in edges.values() for i, k in e if k is not None}
    for _ in range(personal.ROUNDS):
        sure = {}
        for c, e in edges.items():
            for kind in range(4):
                mine = [(n * known[i][1]) for (i, _), n in e.items() if i in known and known[i][0] == kind]
                confidence = sum(mine) / max(totals[c], sum(e.values()))
                if len(mine) >= 3 and confidence >= 0.5 and confidence > sure.get(c, (0, 0))[1]:
                    sure[c] = (kind, confidence)
        doubt = defaultdict(lambda: 1.0)
        for c, (kind, confidence) in sure.items():
            for i, k in edges[c]:
                if k is None:
                    doubt[i, kind] *= 1 - confidence
        for (i, kind), d in doubt.items():
            if 1 - d >= 0.6:
                known[i] = (kind, 1 - d)
    out = []
    for spans, met in per_text:
        every = list(spans)
        for a, b, kind, contexts in met:
            found = [sure[c] for c in contexts if c in sure]
            if kind is None and found:
                every.append((a, 4 + max(found, key=lambda f: (f[1], -f[0]))[0], b))
        names = [*KINDS, *[f"{k}_context" for k in KINDS]]
        out.append((*[sum(k == i for _, k, _ in spans) for i in range(4)], hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest(),
                    ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(every))))
    return out


def labelled(rng, i):
    phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    bare = f"{rng.randint(200, 999)} 555-{rng.randint(1000, 9999)}"
    ip = ".".join(str(rng.randint(0, 255)) for _ in range(4))
    return rng.choice([
        f"please ring me at home on {phone} any day", f"please ring me at home on {bare} any day", f"Reach her: tel:{phone}!", f"Reach her: tel:({bare})",
        f"host at {ip} was up", f"host at server{rng.randint(100, 999)}x was up", f"room number {rng.randint(10000, 99999)} of ours", f"mail=a{i}@b.example.org now", f"mail=a{i}@localhost now",
        f"cell: {bare} or tel:{bare}", f"cell: {rng.randint(200, 999)} 555-{rng.randint(1000, 9999)}",
    ])


def test_base_rules_on_hard_strings():
    rng, finder = random.Random(1), personal.Finder()
    alphabet = ["a", "1", "4", "255", "256", ".", "@", "-", " ", "+", "(", ")", "1.2.3.4", "a@b.co", "4111 1111 1111 1111", "é", "\n", "007", "+1 555", "5555-1234"]
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 30)))
        assert finder.base(text) == base(text), text


def test_long_strings_are_linear():
    finder = personal.Finder()
    for text in ("a" * 400_000, "1" * 400_000, "a." * 200_000 + "@", "1." * 200_000, "+1 " * 100_000, "@" * 400_000, "+1" + "(" * 400_000, "1 " * 200_000):
        list(finder.candidates(text, finder.base(text)))


def test_equal_to_the_plain_computation(spark, monkeypatch):
    monkeypatch.setattr(personal, "PIECE", 60)
    rng = random.Random(2)
    rows = cases() + [row(1000 + i, " ".join(labelled(rng, i) for _ in range(rng.randint(1, 4)))) for i in range(150)]
    rows += [row(5000, "please ring me at home on +1 (222) 555-0000")] * 50  # one instance, however often
    got = personal.extract(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    want = plain([r[1] or "" for r in rows])
    assert Counter(tuple(r)[:7] for r in got) == Counter((r[0], *w) for r, w in zip(rows, want))
    spans = ",".join(r.spans for r in got)
    assert "phone_context" in spans and "email_context" in spans


def test_unseen_numbers_after_sure_words(spark, no_docs):
    assert personal.extract(no_docs).collect() == []
    rows = [row(i, f"call now tel: +1 (555) 555-{1000 + i} ok") for i in range(6)] + [row(50, "call now tel: 555 123-4567 ok"), row(51, "order 555 123-4567 ok")]
    got = {r.doc_id: r.spans for r in personal.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[50] == "phone_context:14:26" and got[51] == ""


def test_query_on_its_table(spark):
    from quarry.llm import common, registry

    texts = {r.doc_id: r.text for r in common.table(spark, SMALL, "documents").collect()}
    ids = list(texts)
    want = dict(zip(ids, plain([texts[i] or "" for i in ids])))
    got = {r.doc_id: tuple(r)[1:7] for r in registry.QUERIES["op11_bootstrapped_contexts"](spark, SMALL).collect()}
    assert got == want
