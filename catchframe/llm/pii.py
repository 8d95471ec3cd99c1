"""Personal data replaced by surrogates, with DataFrame and SQL functions only.

A found span is an e-mail or IP address, a phone, card or account number, a secret, or a
name after a title.  It has a body, whose plain form (lower case, without separators) says
which entity it is, and literal parts that stay, such as a country code.  The surrogate of
an entity is drawn from a keyed hash of its kind and plain form.  It has the same length
and kinds of characters, octets stay octets, a valid card number gets a valid one, a name
one of the same gender and script.  Spans of one entity thus get the same surrogate in
all documents, each in its own format.

Surrogates are checked against all others of their kind and against all entities that
occur; those that collide are drawn again, so distinct entities stay distinct.  A given name is one entity
whatever its titles; their gender chooses the list that its surrogate is drawn from.  Initials go round a keyed ring
of letters of their surname, which maps different initials to different ones and none to itself.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catchframe.llm.common import stored

# Where the query and the pipeline find the key; without it each run has a key of its own.
KEY_SETTING = "spark.catchframe.surrogate.key"
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Señor", "Monsieur", "господин", "г-н", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "госпожа", "г-жа", "κυρία"),
    "u": ("Dr", "Prof", "Mx"),
}
# A name ends before an English genitive.
NAME = r"\p{Lu}(?:[\p{L}\-]|['’](?!s(?!\p{L}))){1,40}+"
INITIAL = r"\p{Lu}\."
GAP = r"[ \t\x{A0}]{1,3}"
TITLE_GAP = rf"(?:{GAP}|[ \t]{{0,2}}\r?\n[ \t]{{0,2}})"
ALL_TITLES = "|".join(t for g in TITLES.values() for t in g)
# Words that may name somebody again.
AGAIN = rf"(?<![\p{{L}}'’\-]){NAME}"
HEX = "[0-9A-Fa-f]{1,4}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Kinds in the order in which they are tried at a place.  Each quantifier over text is bounded,
# and a first look at the next characters ends most trials at once.
KINDS = {
    "email": r"(?<![._%+\-])(?=[A-Za-z0-9._%+\-]{1,64}@)[A-Za-z0-9._%+\-]{1,64}+@(?:[A-Za-z0-9\-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": rf"(?=[0-9]{{1,3}}\.)(?<!\.)(?:{OCTET}\.){{3}}{OCTET}(?!\.?[0-9])",
    "ip6": (
        rf"(?={HEX}:)(?<![:.])(?=[0-9A-Fa-f:]{{0,39}}[0-9])(?:(?:{HEX}:){{7}}{HEX}"
        rf"|{HEX}(?::{HEX}){{0,6}}::(?:{HEX}(?::{HEX}){{0,6}})?)(?![0-9A-Za-z:])"
    ),
    "phone": (
        r"(?=[+(0-9])(?<!\+)(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{2,4}\)[ .\-]?)?[0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){1,3}"
        r"|\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}|[0-9]{3} [0-9]{3} [0-9]{4})(?![0-9])"
    ),
    "ssn": r"(?=[0-9]{3}-)(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "card": r"(?=[0-9]{4})(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|3[47][0-9]{2}(?: [0-9]{6} |-[0-9]{6}-)[0-9]{5})(?![0-9A-Za-z])",
    "iban": r"(?=[A-Z]{2}[0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "secret": (
        r"(?=[0-9a-fA-Fgs])(?:(?=[a-f]{0,31}[0-9])[0-9a-f]{32,128}|(?=[A-F]{0,31}[0-9])[0-9A-F]{32,128}|AKIA(?=[A-Z]{0,15}[0-9])[0-9A-Z]{16}"
        r"|gh[opsu]_(?=[A-Za-z]{0,35}[0-9])[0-9A-Za-z]{36}|sk-(?=[A-Za-z]{0,63}[0-9])[0-9A-Za-z]{20,64})(?![0-9A-Za-z])"
    ),
    "name": (
        rf"(?=[MSHFDPгκ])(?<!\p{{L}})(?:{ALL_TITLES})\.?{TITLE_GAP}(?:{INITIAL}(?:{GAP})?){{0,3}}"
        rf"{NAME}(?:{GAP}(?:{INITIAL}(?:{GAP})?){{0,2}}{NAME}){{0,2}}"
    ),
}
SPAN = f"(?<![0-9A-Za-z])(?:{'|'.join(KINDS.values())})"
# What every text with a span has: a digit, an at sign, or a title.
HINT = " OR ".join(["regexp_like(text, '[0-9@]')", *[f"contains(text, '{t}')" for g in TITLES.values() for t in g]])
# Given names by gender and script, syllables of surnames by script.
GIVEN = {
    "latin_m": ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivo", "Jonas", "Karel", "Leo", "Martin", "Noel", "Oscar", "Paul"),
    "latin_f": ("Ada", "Berta", "Clara", "Dora", "Emma", "Flora", "Greta", "Hanna", "Ida", "Julia", "Klara", "Lena", "Marta", "Nora", "Olga", "Paula"),
    "latin_u": ("Alex", "Charlie", "Dana", "Eden", "Frankie", "Jamie", "Kim", "Lou", "Mika", "Nico", "Quinn", "Robin", "Sam", "Toni", "Val", "Wren"),
    "cyrillic_m": ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"),
    "cyrillic_f": ("Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Ксения"),
    "cyrillic_u": ("Саша", "Женя", "Валя", "Слава"),
    "greek_m": ("Αλέξης", "Βασίλης", "Γιώργος", "Δημήτρης", "Ηλίας", "Κώστας", "Νίκος", "Πέτρος"),
    "greek_f": ("Άννα", "Βάσω", "Δήμητρα", "Ελένη", "Ζωή", "Κατερίνα", "Μαρία", "Σοφία"),
    "greek_u": ("Αγγέλη", "Άρη", "Μάκη", "Σάση"),
}
SYLLABLES = {
    "latin": ("ba", "be", "bo", "da", "de", "do", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "ra", "re", "ro", "sa", "se", "so", "ta", "te", "to", "va", "ve", "vo", "za", "zo"),
    "cyrillic": ("ба", "бо", "ва", "во", "да", "до", "ка", "ко", "ла", "ло", "ма", "мо", "на", "но", "ра", "ро", "са", "со", "та", "то"),
    "greek": ("βα", "βο", "δα", "δο", "κα", "κο", "λα", "λο", "μα", "μο", "να", "νο", "ρα", "ρο", "σα", "σο", "τα", "το"),
}
LETTERS = {
    "latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "cyrillic": "АБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ",
    "greek": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
}
MARKED = "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŁŚŞŠŻŽ"
# Names that are common words too; alone they are a name only after a title.
COMMON = (
    "april", "art", "august", "baker", "bill", "black", "brown", "chase", "christian", "cook", "dawn", "day", "dean", "drew",
    "faith", "frank", "frost", "grace", "grant", "gray", "green", "hall", "hill", "hope", "hunter", "ivy", "jack", "joy", "june",
    "king", "lane", "long", "love", "mark", "mason", "may", "miles", "page", "pat", "penny", "pierce", "price", "ray", "rich",
    "rob", "rose", "short", "snow", "stone", "sue", "summer", "victor", "wade", "ward", "west", "white", "will", "wood", "young",
)
ROUNDS = 8


def _text(value: str) -> str:
    """SQL literal; regular expressions keep their backslashes."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(values: tuple[str, ...]) -> str:
    return f"array({', '.join(map(_text, values))})"


def _title_names(gender: str) -> str:
    return "|".join(TITLES[gender])


def spans(text: str) -> str:
    """SQL text: all spans of a text in order."""
    return f"coalesce(regexp_extract_all({text}, {_text(SPAN)}, 0), cast(array() AS array<string>))"


def occurrence_parts(occurrences: DataFrame) -> DataFrame:
    """``occ``, ``place``, ``kind``, ``before``, ``body``, ``after``, ``gender``, ``core``: the parts of each different span.

    A name has a part per word: given names or initials, then a surname.  Other spans have one part.  An initial's
    ``core`` is its surname's; a given name's gender is that of its title.
    """
    kind = "CASE " + " ".join(f"WHEN regexp_like(occ, {_text('^(?:' + p + ')$')}) THEN '{k}'" for k, p in KINDS.items()) + " END"
    gender = "CASE " + " ".join(f"WHEN regexp_like(occ, {_text(rf'^(?:{_title_names(g)})[.\s\x{{A0}}]')}) THEN '{g}'" for g in TITLES) + " END"
    one = (
        "array(CASE kind"
        r" WHEN 'email' THEN named_struct('kind', kind, 'before', '', 'body', regexp_extract(occ, '^(.*)(\\.[^.]*)$', 1), 'after', regexp_extract(occ, '^(.*)(\\.[^.]*)$', 2))"
        r" WHEN 'phone' THEN named_struct('kind', kind, 'before', regexp_extract(occ, '^(\\+[0-9]{1,3}(?=[^0-9]))?(.*)$', 1), 'body', regexp_extract(occ, '^(\\+[0-9]{1,3}(?=[^0-9]))?(.*)$', 2), 'after', '')"
        " WHEN 'iban' THEN named_struct('kind', kind, 'before', left(occ, 2), 'body', substring(occ, 3), 'after', '')"
        " ELSE named_struct('kind', kind, 'before', '', 'body', occ, 'after', '') END)"
    )
    head = rf"^(?:{ALL_TITLES})\.?{TITLE_GAP}"
    part = rf"{INITIAL}|{NAME}"
    rest = f"regexp_replace(occ, {_text(head)}, '')"
    words = f"regexp_extract_all({rest}, {_text(part)}, 0)"
    gaps = f"split({rest}, {_text(part)}, -1)"
    script = r"CASE WHEN regexp_like(w, '\\p{IsCyrillic}') THEN 'cyrillic' WHEN regexp_like(w, '\\p{IsGreek}') THEN 'greek' ELSE 'latin' END"
    named = (
        f"transform({words}, (w, i) -> named_struct("
        f"'kind', CASE WHEN w LIKE '%.' THEN concat('initial_', {script}) WHEN i = size({words}) - 1"
        f" THEN concat('surname_', {script}) ELSE concat('given_', {script}) END,"
        f" 'before', concat(if(i = 0, regexp_extract(occ, {_text(head)}, 0), ''), {gaps}[i]), 'body', w, 'after', ''))"
    )
    surname = f"lower(element_at({words}, -1))"
    return (
        occurrences.withColumn("kind", F.expr(kind)).where("kind IS NOT NULL")
        .select(
            "occ", F.expr(f"if(kind = 'name', {gender}, NULL)").alias("gender"), F.expr(f"if(kind = 'name', {surname}, NULL)").alias("surname"),
            F.posexplode(F.expr(f"if(kind = 'name', {named}, {one})")).alias("place", "p"),
        )
        .select("occ", "place", "gender", "surname", "p.*")
        .withColumn("core", F.expr(
            r"CASE WHEN kind LIKE 'initial%' THEN surname"
            r" ELSE lower(if(kind IN ('phone', 'ssn', 'card', 'iban'), regexp_replace(body, '[^0-9A-Za-z]', ''), body)) END"
        )).drop("surname")
    )


def with_gender(parts: DataFrame) -> DataFrame:
    """Parts whose given names have the gender of the entity in their kind: that of its Mr, Mrs and the like, else unknown.

    A name after titles of both is unknown; a title that says nothing does not count.
    """
    given = F.col("kind").startswith("given")
    seen = stored(parts.where(given).groupBy("kind", "core").agg(
        F.when(F.bool_or(F.col("gender") == "m") & ~F.bool_or(F.col("gender") == "f"), "m")
        .when(F.bool_or(F.col("gender") == "f") & ~F.bool_or(F.col("gender") == "m"), "f").otherwise("u").alias("of")
    ), "name_genders")
    kind = F.when(given, F.concat_ws("_", "kind", "of")).otherwise(F.col("kind"))
    return parts.join(seen, ["kind", "core"], "left").withColumn("kind", kind).drop("gender", "of")


def initial_sql(key: str) -> str:
    """SQL text: the letter for an initial, the next one on the ring of its surname's keyed order of letters."""
    # Letters with marks have a ring of their own.
    marked = f"WHEN kind = 'initial_latin' AND contains({_text(MARKED)}, left(body, 1)) THEN {_text(MARKED)}"
    rings = f"CASE {marked} " + " ".join(f"WHEN kind = 'initial_{k}' THEN {_text(v)}" for k, v in LETTERS.items()) + " END"
    seed = f"concat_ws('|', {_text(key)}, kind, core"
    ring = f"array_sort(transform(split({rings}, ''), l -> named_struct('h', sha2({seed}, l), 256), 'l', l)))"
    place = "array_position(transform(ring, x -> x.l), left(body, 1))"
    # A letter of no ring gets two letters, which no other initial has.
    other = (
        f"concat(ring[cast(conv(left(sha2({seed}, body), 256), 6), 16, 10) AS int) % size(ring)].l,"
        f" lower(ring[cast(conv(right(sha2({seed}, body), 256), 6), 16, 10) AS int) % size(ring)].l))"
    )
    return f"element_at(transform(array({ring}), ring -> if({place} > 0, ring[cast({place} % size(ring) AS int)].l, {other})), 1)"


def _drawn(key: str) -> str:
    """SQL text of an entity's surrogate from ``kind``, ``core`` and ``attempt``."""
    seed = f"concat_ws('|', {_text(key)}, kind, core, attempt)"
    stream = f"array_join(transform(sequence(0, length(core) div 32 + 1), b -> sha2(concat({seed}, '|', b), 512)), '')"
    number = "cast(conv(substring(stream, 4 * i + 1, 4), 16, 10) AS int)"
    char = "substring(core, i + 1, 1)"
    plain = (
        f"array_join(transform(sequence(0, length(core) - 1), i -> CASE"
        f" WHEN regexp_like({char}, '[0-9]') THEN cast({number} % 10 AS string)"
        f" WHEN kind = 'ip6' AND {char} = ':' THEN ':' WHEN kind = 'ip6' THEN char(97 + {number} % 6)"
        f" WHEN kind = 'secret' AND regexp_like(core, '^[0-9a-f]+$') THEN char(97 + {number} % 6)"
        f" WHEN regexp_like({char}, '[a-z]') THEN char(97 + {number} % 26)"
        f" ELSE {char} END), '')"
    )
    octets = (
        "array_join(transform(split(core, '[.]'), (o, i) -> cast(CASE length(o)"
        f" WHEN 1 THEN {number} % 10 WHEN 2 THEN 10 + {number} % 90 ELSE 100 + {number} % 156 END AS string)), '.')"
    )
    # The last digit makes the number valid exactly if the old one was.
    def luhn(digits: str) -> str:
        return (
            f"aggregate(sequence(1, length({digits})), 0, (a, j) -> a + element_at(if(j % 2 = 0,"
            f" array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), array(0, 1, 2, 3, 4, 5, 6, 7, 8, 9)),"
            f" cast(substring({digits}, length({digits}) - j + 1, 1) AS int) + 1)) % 10"
        )

    card = (
        f"element_at(transform(array({plain}), d -> if({luhn('core')} = 0,"
        f" concat(left(d, length(d) - 1), cast((10 - {luhn("concat(left(d, length(d) - 1), '0')")}) % 10 AS string)), d)), 1)"
    )

    def syllables(script: str, first: int, count: str) -> str:
        made = _array(SYLLABLES[script])
        return f"array_join(transform(sequence({first}, {first} + {count} - 1), i -> element_at({made}, {number} % {len(SYLLABLES[script])} + 1)), '')"

    cases = [f"WHEN kind = 'ip' THEN {octets}", f"WHEN kind = 'card' THEN {card}"]
    for script in SYLLABLES:
        cases.append(f"WHEN kind = 'surname_{script}' THEN initcap({syllables(script, 0, '3 + attempt')})")
        for gender in TITLES:
            names = GIVEN[f"{script}_{gender}"]
            pick = f"element_at({_array(names)}, element_at(transform(array(0), i -> {number}), 1) % {len(names)} + 1)"
            longer = f"if(attempt = 0, '', {syllables(script, 1, 'attempt')})"
            cases.append(f"WHEN kind = 'given_{script}_{gender}' THEN concat({pick}, {longer})")
    drawn = f"CASE {' '.join(cases)} ELSE {plain} END"
    # Where a format has no room left, the hash itself makes the difference.
    tail = f"if(attempt < {ROUNDS}, '', concat('-', left(stream, 4 * (attempt - {ROUNDS - 4}))))"
    return f"element_at(transform(array({stream}), stream -> concat({drawn}, {tail})), 1)"


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``core``, ``surrogate`` for different entities ``kind``, ``core``.

    Each round draws for the entities that are left.  A draw is refused if it is an entity of
    the kind, if it was given before, or if a smaller entity drew it in the same round.
    """
    base = entities.withColumn("attempt", F.lit(0))
    taken = entities.select("kind", F.col("core").alias("surrogate"))
    done, attempt = None, 0
    while True:
        drawn = stored(base.withColumn("surrogate", F.expr(_drawn(key))), f"surrogate_draws_{attempt}")
        free = drawn.withColumn("low", F.lower("surrogate")).join(
            taken.select("kind", F.lower("surrogate").alias("low")).distinct(), ["kind", "low"], "left_anti"
        )
        first = free.groupBy("kind", "low").agg(F.min_by("surrogate", "core").alias("surrogate"), F.min("core").alias("core"))
        given = stored(first.select("kind", "core", "surrogate"), f"surrogates_{attempt}")
        done = given if done is None else done.unionByName(given)
        taken = taken.unionByName(given.select("kind", "surrogate"))
        left = drawn.select("kind", "core").join(given.select("kind", "core"), ["kind", "core"], "left_anti")
        left = stored(left, f"entities_left_{attempt}")
        if left.isEmpty():
            return done
        attempt += 1
        base = left.withColumn("attempt", F.lit(attempt))


def occurrence_surrogates(occurrences: DataFrame, key: str) -> DataFrame:
    """``occ`` and ``new``: what each of the different spans becomes."""
    parts = stored(with_gender(stored(occurrence_parts(occurrences), "plain_parts")), "span_parts")
    whole = "kind NOT LIKE 'initial%'"
    table = stored(surrogates(parts.where(whole).select("kind", "core").distinct(), key), "entity_surrogates")
    # Characters of the body take the surrogate's in turn; separators stay, capitals stay capitals.
    keeps = "(kind IN ('phone', 'ssn', 'card', 'iban') AND NOT regexp_like(c, '[0-9A-Za-z]'))"
    filled = (
        "aggregate(split(body, ''), named_struct('out', '', 'n', 1), (a, c) -> CASE WHEN c = '' THEN a"
        f" WHEN {keeps} THEN named_struct('out', concat(a.out, c), 'n', a.n)"
        " ELSE named_struct('out', concat(a.out, if(c = upper(c), upper(substring(surrogate, a.n, 1)), substring(surrogate, a.n, 1))), 'n', a.n + 1) END,"
        " a -> concat(a.out, substring(surrogate, a.n)))"
    )
    name = "if(length(body) > 1 AND body = upper(body), upper(surrogate), surrogate)"
    new = f"concat(before, if(kind LIKE 'initial%', concat({initial_sql(key)}, '.'), if(kind LIKE 'surname%' OR kind LIKE 'given%', {name}, {filled})), after)"
    joined = parts.join(table, ["kind", "core"], "left").withColumn("new", F.expr(new))
    # The words of a name, for its further occurrences.
    word = F.when(F.expr("kind LIKE 'surname%' OR kind LIKE 'given%'"), F.struct("kind", "core", "surrogate"))
    return joined.groupBy("occ").agg(
        F.array_sort(F.collect_list(F.struct("place", "new"))).alias("p"), F.collect_list(word).alias("words")
    ).select("occ", F.array_join(F.transform("p", lambda x: x.new), "").alias("new"), "words")


def _named_again(piece: str, names: str, alone: str) -> str:
    """SQL text: a piece between spans with its words that are in ``names``, and how often a run of such words starts.

    A word in ``alone`` counts only beside another word of a name, with nothing but blanks between them.
    """
    words = f"regexp_extract_all({piece}, {_text(AGAIN)}, 0)"
    gaps = f"split({piece}, {_text(AGAIN)}, -1)"
    known = f"{names}[lower(x.words[%s])] IS NOT NULL"
    before = f"(i > 0 AND {known % 'i - 1'} AND trim(x.gaps[i]) = '')"
    after = f"(i + 1 < size(x.words) AND {known % 'i + 1'} AND trim(x.gaps[i + 1]) = '')"
    hits = f"transform(x.words, (w, i) -> coalesce({names}[lower(w)] IS NOT NULL AND (NOT array_contains({alone}, lower(w)) OR {before} OR {after}), false))"
    put = f"if(length(w) > 1 AND w = upper(w), upper({names}[lower(w)]), {names}[lower(w)])"
    return (
        f"transform(transform(array(named_struct('words', {words}, 'gaps', {gaps})),"
        f" x -> named_struct('words', x.words, 'gaps', x.gaps, 'hits', {hits})), y -> named_struct("
        f"'text', array_join(zip_with(y.gaps, transform(y.words, (w, i) -> if(y.hits[i], {put}, w)), (g, w) -> concat(g, coalesce(w, ''))), ''),"
        f" 'n', size(filter(y.words, (w, i) -> y.hits[i] AND NOT coalesce(i > 0 AND y.hits[i - 1] AND trim(y.gaps[i]) = '', false)))))[0]"
    )


def _pieces(text: str, names: str, alone: str) -> str:
    """SQL text: the pieces between spans, as structs ``text``, ``n``."""
    return (
        f"transform(split({text}, {_text(SPAN)}, -1), piece -> if({names} IS NULL OR size({names}) = 0,"
        f" named_struct('text', piece, 'n', 0), {_named_again('piece', names, alone)}))"
    )


def ambiguous_sql(text: str, names: str) -> str:
    """SQL text: the words of names that are common words, or that the text also writes in lower case."""
    whole = rf"concat('(?<![\\p{{L}}])', n, '(?![\\p{{L}}])')"
    return (
        f"filter(map_keys({names}), n -> array_contains({_array(COMMON)}, n)"
        f" OR (contains({text}, n) AND regexp_like({text}, {whole})))"
    )


def _replaced(pieces: str, found: str, changes: str) -> str:
    """SQL text: the pieces with the spans between them, listed in ``found``, changed by a map."""
    return (
        f"array_join(zip_with({pieces}, transform({found}, s -> coalesce({changes}[s], s)),"
        " (piece, s) -> concat(piece.text, coalesce(s, ''))), '')"
    )


def with_surrogates(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``row`` (the columns of ``docs``), ``text`` with surrogates, ``spans`` (how many).

    A missing or empty text stays as it is.  Texts without a span are not shuffled; equal
    texts share their changes.  The words of a name found after a title are changed wherever
    they stand in the same text with a capital; words in a row count once.  A word that is a common one, or that the
    text writes in lower case too, is changed only beside another word of a name.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col(f"`{column}`").alias("text"))
    has = F.expr(f"coalesce(({HINT}) AND regexp_like(text, {_text(SPAN)}), false)")
    found = rows.where(has).withColumns({"text_key": F.md5("text"), "found": F.expr(spans("text"))})
    pairs = stored(found.select("text_key", F.explode(F.array_distinct("found")).alias("occ")).distinct(), "text_spans")
    new = stored(occurrence_surrogates(pairs.select("occ").distinct(), key), "span_surrogates")
    changes = pairs.join(new, "occ").groupBy("text_key").agg(
        F.map_from_entries(F.collect_list(F.struct("occ", "new"))).alias("changes")
    )
    # A word that is a given name and a surname in one text is taken as the given name.
    words = pairs.join(new.where("size(words) > 0"), "occ").select("text_key", F.explode("words").alias("w")).groupBy(
        "text_key", "w.core"
    ).agg(F.min_by("w.surrogate", F.struct("w.kind", "w.surrogate")).alias("surrogate"))
    names = words.groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("core", "surrogate"))).alias("names"))
    pieces = found.join(changes, "text_key", "left").join(names, "text_key", "left").withColumn(
        "alone", F.expr(ambiguous_sql("text", "names"))
    ).withColumn("pieces", F.expr(_pieces("text", "names", "alone")))
    changed = pieces.select(
        "row", F.expr(_replaced("pieces", "found", "changes")).alias("text"),
        (F.size("found") + F.expr("aggregate(pieces, 0, (a, p) -> a + p.n)")).alias("spans"),
    )
    same = rows.where(~has).select("row", "text", F.lit(0).alias("spans"))
    return changed.unionByName(same)


def session_key(spark: SparkSession) -> str:
    """The key in the session's settings; without one a new random key, so that surrogates differ from run to run."""
    return spark.conf.get(KEY_SETTING, None) or secrets.token_hex(32)


def replace(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """The documents with surrogates in their texts, in their own columns; ``n_chars`` follows."""
    changed = F.col("row").withField(column, F.col("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withField("n_chars", F.when(F.col("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("row.n_chars")))
    return with_surrogates(docs, key, column).select(changed.alias("row")).select("row.*")


def report(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id``, ``text`` with surrogates, ``n_entities``.

    A missing text stays missing, an empty one empty, both with no entities; a missing id stays, repeated rows stay and
    are changed alike; no documents give no rows.
    """
    return with_surrogates(docs.select("doc_id", "text"), key).select("row.doc_id", "text", F.col("spans").cast("long").alias("n_entities"))
