"""Personal data replaced by keyed surrogates (operator 10, native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, landed

#: Given names by script and gender, titles: fixed values of the detector.
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Richard Thomas Hans Klaus Pierre Carlos".split(),
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Susan Sarah Karen Greta Ingrid Claire Carmen".split(),
    ("cyrillic", "m"): "Иван Сергей Дмитрий Алексей Николай Михаил".split(),
    ("cyrillic", "f"): "Анна Ольга Елена Мария Наталья Ирина".split(),
}
TITLES = "Mr Mrs Ms Dr Herr Frau Mme Sr Sra".split()
#: Syllables and, by gender, endings of surrogate names: 16 of each, one per hexadecimal digit.
SYLLABLES = {"latin": "ba be da do fi go ka le li mo na ra ri so ta ve".split(),
             "cyrillic": "ба бе да до ве го ка ле ли мо на ра ри со та ви".split()}
ENDINGS = {("latin", "m"): "n", ("latin", "f"): "a", ("latin", ""): "rt", ("cyrillic", "m"): "р", ("cyrillic", "f"): "а", ("cyrillic", ""): "нко"}

_NAMES = "|".join(n for names in GIVEN.values() for n in names)
_WORD = r"\p{Lu}[\p{L}'’-]++"
_GAP = r"[ .()/\u00A0\u202F\u2010\u2011\u2013-]{0,3}"
_V4 = r"(?:\d{1,3}\.){3}\d{1,3}"
_H = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    # begins where its run of characters does (dots before it left out), so a run is read once
    "email": r"(?<![\w%+-]|[\w%+-]\.)[A-Za-z0-9_%+-][\w.%+-]*+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}+",
    "secret": r"[0-9a-fA-F]{32,}+(?![0-9A-Za-z])",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?<!\d\.)(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "ssn": r"(?<!\d-)\d{3}-\d{2}-\d{4}(?![\d-])",
    # eight groups, or fewer around "::"; of letters alone at least three
    "ip6": rf"(?:(?:{_H}:){{6}}(?:{_V4}|{_H}:{_H})"
           rf"|(?=[A-Fa-f:]{{0,40}}\d|(?:[A-Fa-f]{{1,4}}::?){{2}})(?:{_H}(?::{_H}){{0,6}})?::(?:(?:{_H}:){{0,5}}{_V4}|{_H}(?::{_H}){{0,6}})?)(?![\p{{L}}\p{{N}}:]|\.\d)",
    # with + and 7 to 15 digits in any grouping; the North American layout; ten digits in a row
    "phone": rf"\+(?!1[ .-]?(?:\(\d{{2,4}}\)[ .-]?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}(?!\d))\(?\d(?:{_GAP}\d){{6,14}}(?!\d)|"
             r"\+?\d{0,3}[ .-]?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<!\d\.)\d{10}(?!\d|\.\d)",
    "card": r"(?:\d{4}[ -]){3}\d{4}(?!\d)|\d{13,19}+(?!\d)",
    # for all but given names looks back only from a capital after a space
    "name": rf"(?:{_NAMES})(?= {_WORD})"
            rf"|(?<= )(?:(?<=(?<!\p{{L}})(?:{'|'.join(TITLES)})\.? )|(?<=(?<!\p{{L}})(?:{_NAMES}) )"
            rf"|(?<=(?<!\p{{L}})(?:{'|'.join(TITLES)})\.? \p{{Lu}}[\p{{L}}'’-]{{1,30}} )){_WORD}",
}
#: What a string of a type may begin with: the next character decides which patterns are tried.
_BEGIN = {"[A-Za-z0-9_%+-]": ("email",), "[0-9a-fA-F:]": ("ip6", "secret"), "[A-Z]": ("iban",), r"[\d+(]": ("ip", "ssn", "phone", "card"), r"\p{Lu}": ("name",)}
#: One pattern for all; a match begins where neither letter nor digit stands before.
ANY = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?={c})(?:{'|'.join(PATTERNS[n] for n in names)})" for c, names in _BEGIN.items()) + ")"


#: Marks the ends of what was found while a text is cut at them.
MARK = "\ue000"


def _cut(text: Column) -> Column:
    """The text in pieces, what was found at every odd place: one search. A text that holds the mark itself is searched twice."""
    marked = F.split(F.regexp_replace(text, ANY, f"{MARK}$0{MARK}"), MARK, -1)
    pairs = F.zip_with(F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda a, b: F.array(a, b))
    return F.when(text.contains(MARK), F.filter(F.flatten(pairs), lambda x: x.isNotNull())).otherwise(marked)


def _characters(x: Column) -> Column:
    return F.split(x, "(?!\\A)(?=.)")


def _luhn(digits: Column, doubled: int) -> Column:
    """Sum of a card's digits where every second is doubled, from the last (``doubled`` 1) or the last but one place on (0)."""
    twice = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    weighed = F.transform(_characters(F.reverse(digits)), lambda c, i: F.when(i % 2 == doubled, twice(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10


def _mod97(x: Column) -> Column:
    """Remainder of the number that digits and letters (a = 10) spell."""
    return F.aggregate(_characters(F.lower(x)), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + c.cast("int")).otherwise(a * 100 + F.ascii(c) - 87) % 97)


def _checked(kind: Column, canonical: Column) -> Column:
    """The type, or ``none`` where a card's or an IBAN's check digits are wrong: some other number."""
    iban = _mod97(F.concat(F.substring(canonical, 5, 99), F.substring(canonical, 1, 4))) == 1
    return F.when((kind == "card") & (_luhn(canonical, 1) != 0) | (kind == "iban") & ~iban, "none").otherwise(kind)


def _kind(raw: Column) -> Column:
    """Type of a found string, names by script and gender."""
    out = F.lit(None).cast("string")
    for (script, gender), names in reversed(GIVEN.items()):
        out = F.when(raw.isin(names), f"given {gender} {script}").otherwise(out)
    out = F.coalesce(out, F.when(raw.rlike(r"\p{IsCyrillic}"), "surname cyrillic").otherwise("surname latin"))
    for name in ("card", "phone", "ssn", "ip", "ip6", "iban", "secret", "email"):
        out = F.when(raw.rlike(rf"\A(?:{PATTERNS[name]})\z"), name).otherwise(out)
    return out


def _groups(raw: Column) -> Column:
    """The eight groups of an IPv6 address, without leading zeros, joined by colons."""
    octet = lambda g, i: F.split_part(g, F.lit("."), F.lit(i)).cast("int")
    pair = lambda g, i: F.hex((octet(g, i) * 256 + octet(g, i + 1)).cast("long"))
    side = lambda i: F.flatten(F.transform(F.filter(F.split(F.split_part(raw, F.lit("::"), F.lit(i)), ":"), lambda g: g != ""),
                                           lambda g: F.when(g.contains("."), F.array(pair(g, 1), pair(g, 3))).otherwise(F.array(g))))
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(side(1)) - F.size(side(2)))
    return F.lower(F.array_join(F.transform(F.concat(side(1), zeros, side(2)), lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":"))


def _canonical(raw: Column, kind: Column) -> Column:
    """What all ways of writing one entity share: letters and digits, lower-cased, for all but e-mail and IP; of IPv6 all groups."""
    return F.when(kind.isin("email", "ip"), F.lower(raw)).when(kind == "ip6", _groups(raw)).when(kind.isin("card", "phone", "ssn", "iban", "secret"),
                                                               F.lower(F.regexp_replace(raw, "[^0-9A-Za-z]", ""))).otherwise(F.lower(raw))


def _stream(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """256 hexadecimal digits drawn from key, type, entity and attempt."""
    parts = [F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, attempt.cast("string"), F.lit(n)).cast("binary"), 512) for n in "01"]
    return F.concat(*parts)


def _draw(stream: Column, i: Column) -> Column:
    """The i-th number from 0 to 255, i from 0."""
    return F.conv(F.substring(stream, F.pmod(i, F.lit(128)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(stream: Column, i: Column, alphabet: str) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(_draw(stream, i), F.lit(len(alphabet))) + 1, F.lit(1))


def surrogate(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """Replacement of a canonical entity, in canonical form; a pure function of its arguments.

    Digits give digits (a leading one stays above zero), letters give letters, of hexadecimal strings
    hexadecimal digits; cards and IBANs get right check digits; IP addresses give octets from 1 to 254 or eight groups of four hexadecimal digits; the last label of an e-mail's domain
    and an IBAN's country stay; names give syllables of their script with an ending of their gender,
    and a syllable more every four attempts.
    """
    s = _stream(key, kind, canonical, attempt)
    chars = F.split(canonical, "(?!\\A)(?=.)")
    fixed = F.when(kind == "email", F.length(canonical) - F.length(F.substring_index(canonical, ".", -1))).otherwise(F.lit(1_000_000))
    skip = F.when(kind == "iban", 2).otherwise(0)
    mapped = F.array_join(F.transform(chars, lambda c, i: (
        F.when((i < skip) | (i >= fixed), c)
        .when((i == 0) & c.rlike("[1-9]") & (kind != "secret"), _pick(s, i, "123456789"))
        .when(kind == "secret", _pick(s, i, "0123456789abcdef"))
        .when(c.rlike("[0-9]"), _pick(s, i, "0123456789"))
        .when(c.rlike("[a-z]"), _pick(s, i, "abcdefghijklmnopqrstuvwxyz")).otherwise(c))), "")
    payload, bban, country = mapped.substr(F.lit(1), F.length(mapped) - 1), F.substring(mapped, 5, 99), F.substring(mapped, 1, 2)
    mapped = (F.when(kind == "card", F.concat(payload, F.pmod(10 - _luhn(payload, 0), F.lit(10)).cast("string")))
              .when(kind == "iban", F.concat(country, F.lpad((98 - _mod97(F.concat(bban, country, F.lit("00")))).cast("string"), 2, "0"), bban)).otherwise(mapped))
    octets = F.array_join(F.transform(F.split(canonical, "\\."), lambda _, i: (F.pmod(_draw(s, i), F.lit(254)) + 1).cast("string")), ".")
    groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.concat(
        _pick(s, i * 4, "123456789abcdef"), *(_pick(s, i * 4 + k, "0123456789abcdef") for k in (1, 2, 3)))), ":")
    extra = F.floor(attempt / 4).cast("int")

    def name(script: str, gender: str, n: int) -> Column:
        syllable = lambda i: F.element_at(F.array(*map(F.lit, SYLLABLES[script])), F.pmod(_draw(s, i), F.lit(16)) + 1)
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), n - 1 + extra), syllable), ""), F.lit(ENDINGS[script, gender]))

    out = F.when(kind == "ip", octets).when(kind == "ip6", groups)
    for script, gender in GIVEN:
        out = out.when(kind == f"given {gender} {script}", name(script, gender, 2))
    return out.when(kind == "surname latin", name("latin", "", 3)).when(kind == "surname cyrillic", name("cyrillic", "", 3)).otherwise(mapped)


def _pour(raw: Column, kind: Column, new: Column) -> Column:
    """The canonical surrogate in the raw string's format: separators and letter case."""
    chars = F.split(raw, "(?!\\A)(?=.)")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    poured = F.aggregate(chars, start, lambda acc, c: F.when(
        c.rlike("[0-9A-Za-z]"), F.struct(
            F.concat(acc["out"], F.when(c.rlike("[A-Z]"), F.upper(F.substring(new, acc["at"], F.lit(1)))).otherwise(F.substring(new, acc["at"], F.lit(1)))).alias("out"),
            (acc["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))))["out"]
    cased = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(new)).when(raw == F.lower(raw), new).otherwise(F.initcap(new))
    hexa = F.when(raw == F.upper(raw), F.upper(new)).otherwise(new)
    return (F.when(kind.startswith("given") | kind.startswith("surname"), cased).when(kind == "ip", new)
            .when(kind.isin("secret", "ip6"), hexa).when(kind == "email", F.when(raw == F.upper(raw), F.upper(new)).otherwise(new)).otherwise(poured))


def surrogates(entities: DataFrame, key: str, max_rounds: int = 60) -> DataFrame:
    """``kind, canonical, new`` for distinct ``kind, canonical``: distinct surrogates, none of them an entity.

    Each round draws for the entities still without a surrogate. A draw that is itself an entity, or
    that an earlier round gave away, or that a lesser entity drew as well, is drawn again. Kinds are
    compared by what they look like, so a phone number's digits may not turn into a card's.
    """
    known = landed(entities.select("kind", "canonical").distinct(), "entities")
    given, open_ = None, known
    for attempt in range(max_rounds):
        drawn = open_.select("kind", "canonical", surrogate(key, F.col("kind"), F.col("canonical"), F.lit(attempt)).alias("new"))
        first = drawn.groupBy("new").agg(F.min(F.struct("kind", "canonical")).alias("of"))
        free = first.join(known.select(F.col("canonical").alias("new")).distinct(), "new", "left_anti")
        if given is not None:
            free = free.join(given.select("new"), "new", "left_anti")
        good = landed(free.select("of.kind", "of.canonical", "new"), "surrogates")
        given = good if given is None else given.unionByName(good)
        open_ = known.join(given.select("kind", "canonical"), ["kind", "canonical"], "left_anti")
        if open_.isEmpty():
            return given
    raise RuntimeError(f"no distinct surrogates after {max_rounds} rounds")


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text, n_entities, kinds`` per row: texts with every detected entity replaced.

    One entity gets one surrogate in all documents, however it is written (letter case, separators);
    name parts are entities of their own, so a surname alone still refers to the full name. Different
    entities get different surrogates, which no document contains as an entity. ``kinds`` lists the
    types found, sorted.

    Numbers that look like a card or an IBAN but whose check digits are wrong stay as they are.

    Each text is searched once, cut and written; a very long one is one cell of that table. A null text stays null with no entity; an empty one stays empty. Repeated rows and null ids are
    handled like any other; an empty table gives an empty result; other columns are not read. Only
    entities and the texts that hold some are shuffled, equal texts once.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.select("id", _cut(F.col("text")).alias("pieces")).withColumn("digest", F.when(F.size("pieces") > 1, F.sha2(F.array_join("pieces", "").cast("binary"), 256)))
    rows = landed(rows, "cut-texts")
    holds = F.coalesce(F.size("pieces"), F.lit(0)) > 1
    found = rows.where(holds).select("digest", F.posexplode("pieces").alias("at", "raw")).where("at % 2 = 1")
    places = landed(found.distinct(), "entity-places").withColumn("kind", _kind(F.col("raw")))
    places = places.withColumn("canonical", _canonical(F.col("raw"), F.col("kind"))).withColumn("kind", _checked(F.col("kind"), F.col("canonical")))
    new = surrogates(places.where("kind <> 'none'"), key)
    put = (places.join(new, ["kind", "canonical"], "left")
           .select("digest", "at", F.coalesce(_pour(F.col("raw"), F.col("kind"), F.col("new")), F.col("raw")).alias("new"), F.substring_index("kind", " ", 1).alias("kind")))
    lists = put.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("at", "new", "kind"))).alias("put"))
    between = F.filter("pieces", lambda _, i: i % 2 == 0)
    rewritten = F.concat(F.array_join(F.zip_with(F.slice(between, 1, F.size("put")), F.col("put"), lambda a, b: F.concat(a, b["new"])), ""), F.element_at(between, -1))
    kinds = F.filter(F.transform("put", lambda x: x["kind"]), lambda k: k != "none")
    changed = (rows.where(holds).select("id", "pieces", "digest").join(lists, "digest")
               .select("id", rewritten.alias("text"), F.size(kinds).cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias("kinds")))
    same = rows.where(~holds).select("id", F.array_join("pieces", "").alias("text"), F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds"))
    return changed.unionByName(same).select(F.col("id").alias(id_col), "text", "n_entities", "kinds")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(documents(spark, sf_dir), key="surrogates-of-the-test-tables")
