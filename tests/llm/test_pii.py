from __future__ import annotations

import re

from catchframe.llm import pii

TEXTS = [
    "write to Ann.Lee@mail.example.com or ann.lee@MAIL.example.com",
    "+1 (415) 555-2671 and (415) 555-2671, ip 10.0.255.7. card 4111 1111 1111 1111 or 4111111111111111",
    'token = "0123456789abcdef0123456789abcdef" 123-45-6789',
    "Mr John Smith met Mrs Anna Smith, Mr Smith and г-н Иван Петров",
    "nothing here: 2024-01-02, 12.5, v1.2.3, Apache License, Version 2.0",
]


def rewritten(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: (r.text, r.n_entities) for r in pii.report(df, key).collect()}


def test_surrogates(spark):
    new = rewritten(spark, TEXTS)
    assert [new[i][1] for i in range(5)] == [2, 5, 2, 4, 0] and new[4][0] == TEXTS[4]
    a, b = re.findall(r"\S+@\S+", new[0][0])
    assert a.lower() == b.lower() and a != "Ann.Lee@mail.example.com" and a.endswith(".com") and a[0].isupper()
    for old in ("415", "4111", "10.0.255", "0123456789ab", "123-45", "John", "Anna", "Smith", "Петров"):
        assert old not in " ".join(t for t, _ in new.values())
    shape = lambda t: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", t)))
    assert all(shape(new[i][0]) == shape(TEXTS[i]) for i in (0, 1))
    cards = [re.sub(r"\D", "", c) for c in re.findall(r"\d{4} ?\d{4} ?\d{4} ?\d{4}", new[1][0])]
    assert len(set(cards)) == 1
    digits = [int(c) for c in reversed(cards[0])]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    names = re.match(r"Mr (\w+) (\w+) met Mrs (\w+) (\w+), Mr (\w+) and г-н (\w+) (\w+)", new[3][0]).groups()
    assert names[1] == names[3] == names[4]
    assert names[0].startswith(pii.GIVEN["latin_m"]) and names[2].startswith(pii.GIVEN["latin_f"]) and names[5].startswith(pii.GIVEN["cyrillic_m"])
    assert rewritten(spark, TEXTS) == new and rewritten(spark, TEXTS, "other")[0] != new[0]


def test_distinct_entities_stay_distinct(spark):
    """All addresses of a small space: many draws collide and are drawn again."""
    core = [f"1.1.{a}.{b}" for a in range(10) for b in range(10)] + [f"Mr {x}a" for x in ("Ab", "Ac", "Ad", "Ae")]
    df = spark.createDataFrame([(c,) for c in core], "occ string")
    got = {r.occ: r.new for r in pii.occurrence_surrogates(df, "k").collect()}
    assert set(got) == set(core) and len(set(got.values())) == len(core) and not set(got.values()) & set(core)


def test_odd_rows(odd, nothing):
    out = pii.replace(odd, "k")
    assert out.columns == odd.columns
    # Of the long text's numbers some are groups like a card's; all other rows have no span.
    assert out.count() == odd.count()
    rows = [sorted(map(str, df.where("coalesce(doc_id, 0) != 5").collect())) for df in (out, odd)]
    assert rows[0] == rows[1]
    assert pii.replace(nothing, "k").count() == 0


def test_own_columns_only(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.org now", "en", "s", 18)], "doc_id long, text string, lang string, source string, n_chars long")
    row = pii.replace(df, "k").first()
    assert row.text != "mail a.b@c.org now" and row.n_chars == len(row.text) and row.lang == "en"


def test_named_again(spark):
    """A name found once is changed in the rest of its text only, alone, in a row, in capitals and with a genitive."""
    new = rewritten(spark, [
        "Mr John Smith came. Smith said so; JOHN SMITH left. Smith's hat, Blacksmith, Smithson", "Smith and John",
        "Dr. J. Smith, Dr J.R. Smith; Prof.  Adams and Ms\nBaker, Mr John F. Kern. Kern left",
    ])
    a, b, c, d, e, f = re.fullmatch(
        r"Mr (\w+) (\w+) came\. (\w+) said so; (\w+) (\w+) left\. (\w+)'s hat, Blacksmith, Smithson", new[0][0]).groups()
    assert b == c == f and d == a.upper() and e == b.upper() and {a, b}.isdisjoint({"John", "Smith"})
    assert new[0][1] == 4 and new[1] == ("Smith and John", 0)
    m = re.fullmatch(r"Dr\. [A-Z]\. (\w+), Dr [A-Z]\.[A-Z]\. (\w+); Prof\.  (\w+) and Ms\n(\w+), Mr (\w+) [A-Z]\. (\w+)\. (\w+) left", new[2][0])
    assert m and m[1] == m[2] == b and m[6] == m[7] and new[2][1] == 6
    assert not {"Smith", "Adams", "Baker", "John", "Kern"} & set(m.groups())


def test_more_formats(spark):
    old = ["call 415 555 2671 now", "card 3782 822463 10005 or 378282246310005", "from 2001:db8::8a2e:370:7334 to 2001:DB8:0:0:8:800:200C:417A", "std::vector at 10:20:30, a::b"]
    new = rewritten(spark, old)
    assert [new[i][1] for i in range(4)] == [1, 2, 2, 0] and new[3][0] == old[3]
    assert re.fullmatch(r"call \d{3} \d{3} \d{4} now", new[0][0]) and "555 2671" not in new[0][0]
    a, b = re.fullmatch(r"card (\d{4} \d{6} \d{5}) or (\d{15})", new[1][0]).groups()
    assert a.replace(" ", "") == b != "378282246310005"
    assert re.fullmatch(r"from \d{4}:[a-f]{2}\d::\d[a-f]\d[a-f]:\d{3}:\d{4} to \d{4}:[A-F]{2}\d:\d:\d:\d:\d{3}:\d{3}[A-F]:\d{3}[A-F]", new[2][0])
    assert "370:7334" not in new[2][0] and "200C:417A" not in new[2][0]


def test_one_person_has_one_name(spark):
    """The title does not matter: a given name is one entity, and a Mr or Mrs anywhere gives its gender."""
    new = rewritten(spark, ["Dr John Smith came. Mr John Smith left.", "Prof. John Adams", "Dr Kim Lee, Mr Kim Lee, Mrs Kim Lee", "Dr Vera Holm"])
    a, b, c, d = re.fullmatch(r"Dr (\w+) (\w+) came\. Mr (\w+) (\w+) left\.", new[0][0]).groups()
    assert (a, b) == (c, d) and a.startswith(pii.GIVEN["latin_m"])
    assert new[1][0].startswith(f"Prof. {a} ")
    names = set(re.findall(r"(?:Dr|Mr|Mrs) (\w+) (\w+)", new[2][0]))
    assert len(names) == 1 and next(iter(names))[0].startswith(pii.GIVEN["latin_u"])
    assert new[3][0].split()[1].startswith(pii.GIVEN["latin_u"])


def test_initials_stay_distinct(spark):
    """People with one surname: as many different initials after as before, and none that it was."""
    letters = "ABCDEFGHJKLMNOPQRSTUVWXYZÉØ"
    new = rewritten(spark, [" ".join(f"Dr {c}. Smith," for c in letters) + " Dr A. Kern, Dr Ŵ. Kern"])[0][0]
    found = re.findall(r"Dr (\w+)\. (\w+)", new)
    assert len(set(found)) == len(letters) + 2 and len({s for _, s in found}) == 2
    assert all(new != old for (new, _), old in zip(found, letters))
    assert rewritten(spark, ["Dr J. Smith", "Prof. J. Smith"])[0][0][3:] == rewritten(spark, ["Prof. J. Smith"])[0][0][6:]


def test_common_words_stay(spark):
    new = rewritten(spark, [
        "Mr Will May came in May. May I go? Will you? So Will May left.",
        "Ms Ann Stein wrote. A stein of beer. Stein was here, Ann Stein too.",
    ])
    a, b, c, d = re.fullmatch(r"Mr (\w+) (\w+) came in May\. May I go\? Will you\? So (\w+) (\w+) left\.", new[0][0]).groups()
    assert (a, b) == (c, d) and {a, b}.isdisjoint({"Will", "May"}) and new[0][1] == 2
    a, b, c, d = re.fullmatch(r"Ms (\w+) (\w+) wrote\. A stein of beer\. Stein was here, (\w+) (\w+) too\.", new[1][0]).groups()
    assert (a, b) == (c, d) and b != "Stein"


def test_key(spark):
    """Without a key in the session each run has its own."""
    df = spark.createDataFrame([(1, "mail a.b@c.org now")], "doc_id long, text string")
    assert pii.report(df, pii.session_key(spark)).first().text != pii.report(df, pii.session_key(spark)).first().text
    spark.conf.set(pii.KEY_SETTING, "one")
    same = [pii.report(df, pii.session_key(spark)).first().text for _ in range(2)]
    spark.conf.unset(pii.KEY_SETTING)
    assert same[0] == same[1] == pii.report(df, "one").first().text
