import hashlib
import random
import re

import pytest

from corpusprep.llm import secrets

PATTERNS = {  # the base kinds as stated by the contract, for an independent scan
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def brute(text):
    text = text or ""
    out = []
    for i, (kind, p) in enumerate(PATTERNS.items()):
        for m in p.finditer(text):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), i, m.end(), kind))
    return [(k, s, e) for s, _, e, k in sorted(out)]


@pytest.fixture(scope="module")
def scan():
    return secrets.scanner(secrets.RULES)


def base(spans):
    return [(x["kind"], x["start"], x["end"]) for x in spans if x["kind"] in secrets.BASE]


CASES = [None, "", "password=abcdef", "PassWord' : \"abc.def-1", "token=token:abcdef", "token=secret=abcdefgh", "token==abcdef", "token=abcde", "api_key:x/y+z=9", "apikey=12345",
         "AKIA" + "A" * 16, "AKIA" + "A" * 15, "AKIAAKIA" + "0" * 16, "AKIA", "a" * 24, "a" * 23 + "g" + "0" * 30, "é😀 secret = 'äbcdefgh", "😀 token:abcdefé" + "f" * 25,
         "\u017fecret=abcdefg", "to\u212aen=abcdefg", "token   :   abcdefg", "token=\"" + "f" * 24, "passwd:" + "0a" * 3000, "f" * 100_000, "secret_token=abcdef", "token=ab\"secret=abcdefg"]


def test_cases(scan):
    for t in CASES:
        assert base(scan.spans(t)) == brute(t), t


def test_random_texts(scan):
    rng = random.Random(8)
    parts = ["token", "secret", "PASSWORD", "api_key", "apikey", "api", "_", "=", ":", " ", "'", '"', "AKIA", "A0Z", "0123456789", "abcdef", "f", "x", ".", "é", "ghp_", "-"]
    for _ in range(6000):
        t = "".join(rng.choices(parts, k=rng.randrange(0, 25)))
        assert base(scan.spans(t)) == brute(t), t


def test_every_rule_against_its_pattern(scan):
    rng = random.Random(3)
    samples = {"github": "ghp_" + "a1B2" * 9, "slack": "xoxb-" + "1a-" * 6, "google": "AIza" + "aB_-9" * 7, "private_key": "-----BEGIN RSA PRIVATE KEY-----"}
    for rule in secrets.RULES[3:]:
        text = "x " + samples[rule.kind] + " é " + samples[rule.kind][:-3]
        want = [(m.start(), m.end()) for m in re.finditer(rule.pattern, text) if len(m[0]) >= rule.least]
        assert [(x["start"], x["end"]) for x in scan.spans(text) if x["kind"] == rule.kind] == want != []
    for _ in range(2000):
        t = "".join(rng.choices([*samples.values(), "ghp_", "xoxb-1", "AIza", "-", "A", "a", " ", "-----BEGIN "], k=rng.randrange(1, 12)))
        got = [(x["kind"], x["start"], x["end"]) for x in scan.spans(t) if x["kind"] not in secrets.BASE]
        want = sorted(((m.start(), i, m.end(), r.kind) for i, r in enumerate(secrets.RULES) for m in re.finditer(r.pattern, t) if i > 2 and len(m[0]) >= r.least))
        assert got == [(k, s, e) for s, _, e, k in want], t


def test_automaton_is_minimal_and_total():
    rules = (secrets.Rule("a", "(ab|cb)"), secrets.Rule("b", "x{2,3}y?"))
    step, accept = secrets.compile_rules(rules, anywhere=True)
    assert step.shape[1] == 256 and step.max() < len(step) and set(accept) == {0, 1, 2}
    assert len({(a, *r) for a, r in zip(accept.tolist(), step.tolist())}) == len(step)
    with pytest.raises(ValueError):
        secrets.compile_rules((secrets.Rule("z", r"a\b"),), anywhere=True)


def test_query_on_whole_table(spark):
    from corpusprep.llm.registry import op6_secrets

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_secrets(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(w[0] == k for w in want) for k in secrets.BASE)
        assert r["base_sha256"] == hashlib.sha256(",".join("%s:%d:%d" % w for w in want).encode()).hexdigest()
        assert {"%s:%d:%d" % w for w in want} <= set(r["spans"].split(","))


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "token=abcdef", "b")], "doc_id long, text string, kind string")
    rows = secrets.find_secrets(df).collect()
    assert sorted(len(r["spans"]) for r in rows) == [0, 0, 1]
    assert secrets.find_secrets(df.limit(0)).count() == 0


def test_one_long_match_takes_little_memory():
    import tracemalloc

    data = "x " + "ab12" * 500_000 + " password=" + "Z" * 500_000
    scan = secrets.scanner(secrets.RULES)
    tracemalloc.start()
    spans = scan.spans(data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(x["kind"], x["start"], x["end"]) for x in spans] == [("hex", 2, 2_000_002), ("assign", 2_000_003, 2_500_012)]
    assert peak < 4 * len(data)


def test_clashing_column_is_refused(spark):
    import pytest

    with pytest.raises(ValueError):
        secrets.find_secrets(spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, Spans string"))
