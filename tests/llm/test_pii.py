import datetime
import re

import pytest

from corpusprep.llm import pii

KEY = b"0123456789abcdef"


@pytest.fixture(scope="module")
def names():
    return pii.Pseudonyms(KEY)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 4099])
def test_a_permutation_of_the_range(names, size):
    assert sorted(names.permute(x, size, "t") for x in range(size)) == list(range(size))


def test_dates_are_permuted_within_the_calendar(names):
    n = datetime.date(2099, 12, 31).toordinal() - datetime.date(1900, 1, 1).toordinal() + 1
    assert len({names.permute(x, n, "date") for x in range(n)}) == n


@pytest.mark.parametrize("widths", [(1, 1), (1, 2), (2, 1)])
def test_dates_of_one_width_are_permuted_among_themselves(names, widths):
    month, day = widths
    dates = [(y, m, d) for y in range(2000, 2003) for m in range(1, 13) for d in range(1, 32) if len(str(m)) <= month and len(str(d)) <= day and (m, d) not in ((2, 29), (2, 30), (2, 31)) and not (d == 31 and m in (4, 6, 9, 11))]
    new = {names._moved(*x, *widths) for x in dates}
    assert len(new) == len(dates) and all(1900 <= y <= 2099 and (month == 2 or m < 10) and (day == 2 or d < 10) for y, m, d in new)


VALUES = {
    "email": ["jo.24@mail4.example.com", "A_b+c@x.org"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "ip": ["9.122.68.47", "255.0.0.1"],
    "date": ["2024-02-29", "31/12/1999", "12/31/1999", "01.02.2003", "4/7/1985", "3.7.2021", "24/7/1985", "1812-09-07", "14/07/1789", "2150-01-01"],
    "ssn": ["123-45-6789", "899-99-9999"],
    "card": ["4111 1111 1111 1111", "5500-0000-0000-0004", "4111111111111111"],
    "phone": ["+1 (788) 555-2942", "(212) 555-0199", "212-555-0199", "+12125550199", "+1 (017) 555-7713", "+1 (132) 155-1352",
              "212 555 0199", "+44 20 7946 0958", "+49 (0)30 901820", "+33 1 42 68 53 00", "+34912345678", "+353 1 234 5678", "+7 495 123-45-67"],
}
LEFT = ["4111 1111 1111 1112", "9093441080585870", "256.1.1.1", "1.2.3", "2023-02-29", "99/99/1999", "000-12-3456", "666-12-3456", "123-00-4567", "DE88370400440532013000",
        "@example.com", "a@b", "0000000000000000", "1.2.3.4.5", "v2.0.", "12345", "(112) 555-0199", "112 555 0199", "212 155 0199", "+44 20", "+4420794609581234567", "+83 12345678", "+44 0207946095",
        "30/2/1985", "0/7/1985", "1.2.99", "3.14.159", "12.212-555-0199"]


def shape(s):
    return re.sub(r"[0-9]", "0", re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", s)))


@pytest.mark.parametrize("kind", pii.KINDS)
def test_formats_and_checks_hold(names, kind):
    for value in VALUES[kind]:
        text = f"x {value}, y"
        new, spans = pii.pseudonymise(text, names)
        assert [s["kind"] for s in spans] == [kind], value
        got = new[spans[0]["start"]:spans[0]["end"]]
        assert new == f"x {got}, y" and got != value
        if kind != "ip":
            assert shape(got) == shape(value)
        again = pii.replacements(new, names)  # the pseudonym passes the same check
        assert [x[:3] for x in again] == [(spans[0]["start"], spans[0]["end"], kind)]


def test_equal_values_stay_linked(names):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    assert digits(names.card("4111 1111 1111 1111")) == names.card("4111111111111111")
    assert digits(names.phone("+1 (212) 555-0199"))[1:] == digits(names.phone("212-555-0199"))
    assert names.date("2003-02-01").split("-")[::-1] == names.date("01.02.2003").split(".")
    assert names.email("Jo.24@x.org").lower() == names.email("jo.24@X.org").lower()
    assert pii.Pseudonyms(b"another key of 16 b").card("4111111111111111") != names.card("4111111111111111")
    assert names.date("2024-02-29") == datetime.date.fromisoformat(names.date("2024-02-29")).isoformat()


def test_a_full_stop_hides_nothing(names):
    for before in ("Tel.", "Fax:", "end. ", "(", "v."):
        assert pii.pseudonymise(f"{before}212-555-0199.", names)[0] == f"{before}{names.phone('212-555-0199')}."
        assert pii.pseudonymise(f"{before}4/7/1985", names)[0] == f"{before}{names.date('4/7/1985')}"


def test_failed_candidates_hide_nothing(names):
    card = names.card("4111 1111 1111 1111")
    assert pii.pseudonymise("AB12 4111 1111 1111 1111 x", names)[0] == f"AB12 {card} x"
    assert pii.pseudonymise("9 4111 1111 1111 1111 x", names)[0] == f"9 {card} x"
    assert pii.pseudonymise("4111 1111 1111 1111 5 x", names)[0] == f"{card} 5 x"
    assert pii.pseudonymise("BE68 5390 0754 7034 THIS", names)[0] == f"{names.iban('BE68 5390 0754 7034')} THIS"
    outside = {names.phone(f"+1 (0{i:02d}) 555-{i:04d}") for i in range(50)}
    assert len(outside) == 50 and not any(re.match(r"\+1 \([2-9]\d\d\) [2-9]", x) for x in outside)


def test_clean_text_is_left_alone(names):
    for value in LEFT:
        assert pii.pseudonymise(f"x {value} y", names) == (f"x {value} y", []), value
    for text in (None, "", "é😀", "@" * 50, "a" * 100_000 + "@", "1" * 100_000, "1 " * 50_000, "." * 1000 + "@x.org"):
        assert pii.pseudonymise(text, names) == (text, [])


def test_documents(spark):
    df = spark.createDataFrame([(1, "card 4111111111111111", "k"), (2, "again: 4111111111111111.", "k"), (2, None, "k"), (None, "", None)], "doc_id long, text string, kind string")
    rows = pii.pseudonymise_documents(df, KEY).collect()
    found = {r["text"][s["start"]:s["end"]] for r in rows if r["text"] for s in r["spans"]}
    assert len(rows) == 4 and len(found) == 1 and found != {"4111111111111111"}
    assert pii.pseudonymise_documents(df.limit(0), KEY).count() == 0
    with pytest.raises(ValueError):
        pii.pseudonymise_documents(df, b"short")


def test_query_against_plain_function(spark):
    from corpusprep.llm.registry import PII_KEY, op9_pii

    sf = "/root/testdata/sf0.001"
    names = pii.Pseudonyms(PII_KEY)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_pii(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        new, spans = pii.pseudonymise(texts[r["doc_id"]], names)
        assert r["text"] == new and sum(r[f"n_{k}"] for k in pii.KINDS) == len(spans)
        for mail in re.findall(r"[\w.]+@mail\d\.example\.com", texts[r["doc_id"]]):
            assert mail not in r["text"]


def test_clashing_column_is_refused(spark):
    with pytest.raises(ValueError):
        pii.pseudonymise_documents(spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, SPANS string"), KEY)


# -- an independent twin: plain scans with the definitions of the kinds, permutations checked through their inverse ---------
def _plain_feistel(key, x, size, kind, back=False):
    """The keyed permutation, written from its definition; ``back`` undoes it."""
    import hashlib
    import math

    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    wide = (max(a, b).bit_length() + 7) // 8

    def mask(i, half):
        out, at = b"", 0
        while at < wide + 16:
            out += hashlib.blake2b(f"{kind}:{size}:{i}:".encode() + half.to_bytes(wide, "big"), key=key, salt=at.to_bytes(16, "big")).digest()
            at += 64
        return int.from_bytes(out[:wide + 16], "big")

    while True:
        left, right = x // b, x % b
        for i in reversed(range(pii.ROUNDS)) if back else range(pii.ROUNDS):
            sign = -1 if back else 1
            if i % 2 == 0:
                left = (left + sign * mask(i, right)) % a
            else:
                right = (right + sign * mask(i, left)) % b
        x = left * b + right
        if x < size:
            return x


def test_permutation_against_its_plain_inverse(names):
    import random

    r = random.Random(4)
    for _ in range(300):
        size = r.choice([2, 7, 1000, 73049, 2**32, 10**14, 36**20])
        x = r.randrange(size)
        y = _plain_feistel(KEY, x, size, "k")
        assert y == names.permute(x, size, "k") and _plain_feistel(KEY, y, size, "k", back=True) == x


def test_query_finds_what_plain_scans_find(spark):
    """Every planted value of the tables, found by simple patterns and checked by plain rules, is gone from the query's texts;
    texts without digits and @ come back as they were."""
    from corpusprep.llm.registry import op9_pii

    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    new = {r["doc_id"]: r["text"] or "" for r in op9_pii(spark, sf).collect()}
    luhn = lambda d: sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
    found = 0
    for doc, text in texts.items():
        mails = re.findall(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", text)
        phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}(?!\d)", text)
        cards = [c for c in re.findall(r"(?<![\w.-])\d{4} \d{4} \d{4} \d{4}(?![ -]?\d)", text) if luhn(c.replace(" ", "")) and len(set(c)) > 2]
        addresses = [a for a in re.findall(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w.])", text) if all(int(x) < 256 and str(int(x)) == x for x in a.split("."))]
        for value in [*mails, *phones, *cards, *addresses]:
            found += 1
            assert value not in new[doc], (doc, value)
        if not re.search(r"[0-9@]", text):
            assert new[doc] == text
    assert found > 20
