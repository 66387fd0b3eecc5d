import datetime as dt
import hashlib
import re

from fieldlens.llm import pii

KEY = "k"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def feistel(digits, radix, kind):
    half = len(digits) // 2
    a, b, ra, rb = digits[:half], digits[half:], radix[:half], radix[half:]
    for k in range(pii.ROUNDS):
        seen = sha("|".join([KEY, kind, str(k), ",".join(map(str, b))]))
        shifts = [int(sha(f"{seen}|{i // 4}")[i % 4 * 15:][:15], 16) for i in range(len(a))]
        moved = [(x + y) % r for x, y, r in zip(a, shifts, ra)]
        a, b, ra, rb = b, moved, rb, ra
    return a + b


def luhn(d):
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d))) % 10 == 0


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in pii.pseudonymize(df, KEY).orderBy("doc_id").collect()]


def test_cards_against_brute_force(spark):
    cards = ["4111111111111111", "5500-0055-5555-5559", "3400 000000 00009", "6011000000000004"]
    rows = run(spark, [f"pay {c}, now" for c in cards])
    for c, r in zip(cards, rows):
        d = [int(x) for x in c if x.isdigit()]
        body = feistel(d[:-1], [10] * (len(d) - 1), "card")
        last = next(x for x in range(10) if luhn(body + [x]))
        new = iter(map(str, body + [last]))
        assert r.text == "pay " + "".join(next(new) if x.isdigit() else x for x in c) + ", now"
        assert [f.kind for f in r.findings] == ["card"]


def test_other_kinds_keep_their_format(spark):
    texts = ["123-45-6789", "97.51.17.173", "2001-02-28", "28.02.2001", "02/28/2001", "+1 (017) 555-7713", "a.B34@mail7.example.com",
             "04dbebab91ab85687d33eeaaf9ac699e1188f962", "DE89370400440532013000"]
    rows = [r.text for r in run(spark, texts)]
    assert all(a != b and re.sub(r"\d", "9", a) != "" for a, b in zip(texts, rows))
    area, group, serial = feistel([122, 44, 6788], [898, 99, 9999], "ssn")
    area += 1
    assert rows[0] == f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"
    assert rows[1] == ".".join(map(str, feistel([97, 51, 17, 173], [256] * 4, "ipv4")))
    day = (dt.date(2001, 2, 28) - dt.date(1800, 1, 1)).days
    a, b = feistel([day // 773, day % 773], [189, 773], "date")
    new = dt.date(1800, 1, 1) + dt.timedelta(a * 773 + b)
    assert rows[2:5] == [new.strftime(f).replace("1800", str(new.year)) for f in ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y")]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", rows[5])
    assert re.fullmatch(r"[a-z]\.[A-Z]\d\d@[a-z]{4}\d\.[a-z]{7}\.com", rows[6])
    assert "".join("%x" % d for d in feistel([int(c, 16) for c in texts[7]], [16] * 40, "secret")) == rows[7]
    number = "".join(str(int(c, 36)) for c in rows[8][4:] + rows[8][:4])
    assert int(number) % 97 == 1 and rows[8].startswith("DE")


def test_a_permutation(spark):
    df = spark.range(256 * 16).selectExpr("id AS doc_id", "concat('10.0.', cast(id div 256 AS int), '.', id % 256) AS text")
    out = pii.pseudonymize(df, KEY)
    assert out.select("text").distinct().count() == 256 * 16
    days = spark.sql("SELECT date_format(date_add(date'1800-01-01', cast(id AS int)), 'yyyy-MM-dd') AS text FROM range(0, 146097, 7)")
    assert pii.pseudonymize(days, KEY).select("text").distinct().count() == days.count()


def test_linking_and_clean_text(spark):
    clean = ["4111111111111112 is no card", "300.1.1.1", "1999-02-30 2400-01-01", "000-12-3456", "GB00WEST12345698765432",
             "x1234567890", "version 1.2.3", None, "", "a @ b", "0" * 40]
    rows = run(spark, clean)
    assert [r.text for r in rows] == clean and not any(r.findings for r in rows)
    a, b = run(spark, ["+1 (017) 555-7713 and 4111111111111111.", "4111-1111-1111-1111 x +1 017 555 7713"])
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(a.text)[:11] == digits(b.text)[-11:] and digits(a.text)[11:] == digits(b.text)[:16]


def test_edges_and_plan(spark, edge, empty):
    out = pii.pseudonymize(edge.withColumn("Findings", edge.score), KEY)
    assert out.count() == edge.count() and [c for c in out.columns if c.lower() == "findings"] == ["findings"]
    assert pii.pseudonymize(empty, KEY).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def by_class(value, kind):
    base = lambda c: "0" if c.isdigit() else "A" if c.isupper() else "a"
    own = [c for c in value if c.isascii() and c.isalnum()]
    new = iter(feistel([ord(c) - ord(base(c)) for c in own], [10 if c.isdigit() else 26 for c in own], kind))
    return "".join(chr(ord(base(c)) + next(new)) if c.isascii() and c.isalnum() else c for c in value)


def test_email_iban_and_phone_against_brute_force(spark):
    mail, iban, phones = "a.B34_x@mail-7.example.com", "DE89370400440532013000", ["+1 (017) 555-7713", "(212) 555-0199", "+442071838750"]
    rows = [r.text for r in run(spark, [mail, iban, *phones])]
    assert rows[0] == by_class("a.B34_x@mail-7.example", "email") + ".com"
    account = by_class(iban[4:], "iban")
    number = int("".join(str(int(c, 36)) for c in account + "DE00"))
    assert rows[1] == f"DE{98 - number % 97:02d}{account}"
    for old, new, country in zip(phones, rows[2:], (1, 0, 2)):
        d = [int(c) for c in old if c.isdigit()]
        if old == "+442071838750":
            country = len(re.search(r"^\+([0-9]{1,3}?)(?=[0-9]{7,12}$)", old)[1])
        fresh = iter(map(str, d[:country] + feistel(d[country:], [10] * (len(d) - country), "phone")))
        assert new == "".join(next(fresh) if c.isdigit() else c for c in old)


def test_very_long_texts(spark):
    hexes = ("0123456789abcdef" * 4096)[:65_536]
    texts = ["x@a" + ".b" * 500_000, "a." * 500_000, "x@" + "a" * 1_000_000 + ".com", hexes, "f" * 1_000_000,
             "1-" * 500_000, "(12) " * 200_000, "u@" + "ab." * 126 + "com", "u@" + "ab." * 127 + "com"]
    rows = run(spark, texts)
    assert [bool(r.findings) for r in rows] == [False, False, False, True, False, False, False, True, True]
    assert rows[3].text == "".join("%x" % d for d in feistel([int(c, 16) for c in hexes], [16] * len(hexes), "secret"))
    assert rows[7].text.endswith(".com") and len(rows[7].text) == len(texts[7])
