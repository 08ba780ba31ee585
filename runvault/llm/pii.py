"""Keyed surrogates for personal data.

Mentions (e-mail addresses, phone and card numbers, IPv4 addresses, social
security numbers, credentials, and names after a title) are found by one
pattern; a number shaped like a card is one only if its Luhn sum is a multiple
of ten.  In a text with a found name, capitalised words elsewhere in it that repeat
the given or family part get that part's surrogate too (of equal parts of
several names the first's), so that a person stays one person; they are no
mentions of their own in ``n_mentions``.  Names that never follow a title
in their text, and credentials without a name before them or with signs other
than letters, digits and ``_-/+``, are not detected.  A mention is reduced to canonical entities: a phone number to its
national digits, a credential to its value, a name to its given and family part, so different spellings
of one entity agree.  Every distinct entity of the corpus gets a surrogate of
its type drawn by a keyed hash: letters, digits, case and separators keep
their places, card numbers keep their network and check digit, given names keep gender and
script, family names their script, and e-mail domains end in ``example`` with
their own top level.  After four refused draws an address of the internet keeps its four
numbers but not their lengths, after six an e-mail address gets a longer local part.

Collision check: a candidate is refused if it is an entity of the corpus, if
it is given out already, or if another entity drew it too and sorts first; the
refused draw again with the next attempt.  So different entities stay
different, equal ones stay equal across all documents, and no surrogate is
somebody's real value.  The surrogates are then written into each mention in
the mention's own format, and everything else of a text stays as it is.

The entity table is distributed and only entities, never texts, take part in
the draws; only texts with a mention are shuffled.  Null texts stay null, and
texts without a mention come back unchanged.  Repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runvault.llm.common import cut, let, pick
from runvault.llm.registry import query, table

KEY = "surrogates-1"
ROUNDS = 64

# fixed values: titles and common given names by gender and script
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа")
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "г-н", "господин")
OTHER_TITLES = ("Dr", "Prof", "д-р")
GIVEN = {
    ("f", "latin"): ("anna", "clara", "elena", "emma", "julia", "laura", "lucia", "maria", "nina", "paula", "sarah", "sofia"),
    ("m", "latin"): ("adam", "daniel", "david", "felix", "hugo", "jonas", "lucas", "martin", "oscar", "peter", "simon", "thomas"),
    ("f", "cyrillic"): ("анна", "вера", "галина", "елена", "ирина", "мария", "нина", "ольга", "софия", "юлия"),
    ("m", "cyrillic"): ("антон", "борис", "виктор", "глеб", "денис", "иван", "кирилл", "максим", "олег", "павел"),
}
SYLLABLES = {"latin": ("bal", "cor", "dar", "fen", "gar", "hol", "ker", "lam", "mor", "nel", "ost", "par", "ron", "sel", "tam", "ver"),
             "cyrillic": ("бал", "вор", "гар", "дол", "зам", "кор", "лан", "мир", "нав", "пол", "рад", "сол", "тар", "фед", "хол", "чер")}
FAMILY_END = {("latin", "f"): "en", ("latin", "m"): "en", ("latin", "u"): "en",
              ("cyrillic", "f"): "ова", ("cyrillic", "m"): "ов", ("cyrillic", "u"): "ов"}
GIVEN_END = {("latin", "f"): "a", ("latin", "m"): "o", ("cyrillic", "f"): "ия", ("cyrillic", "m"): "ей"}

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: starts at the front of a run of its signs only, so that long runs are read once
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
#: a credential's name and what stands between it and the value; other words may run into the name
ASSIGNED = r"(?i:password|passwd|token|secret|api[_\-]?key)[\x22']?\s{0,2}[=:]\s{0,2}[\x22']?"
VALUE = r"(?=[A-Za-z_\-/+]*[0-9])[0-9A-Za-z_\-/+]{8,}"
SECRET = rf"AKIA[0-9A-Z]{{16}}|{ASSIGNED}{VALUE}"
IP = rf"{OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])"
CARD = (r"(?:[3-6][0-9]{3}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720))(?:[ \-]?[0-9]{4}){3}(?![0-9])"
        r"|3[47][0-9]{2}[ \-]?[0-9]{6}[ \-]?[0-9]{5}(?![0-9])")
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
PHONE = r"(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])|\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){2,4}(?![0-9])"
TITLE = "(?:" + "|".join(FEMALE_TITLES + MALE_TITLES + OTHER_TITLES) + r")\.?"
#: a part of a name, without a possessive ending; up to five pieces joined by hyphens or apostrophes
PART = r"\p{Lu}(?=['’\-]?\p{L})\p{L}*+(?:(?:-|['’](?!s(?!\p{L})))\p{L}++){0,4}"
NAME = rf"{TITLE} {PART}(?: {PART})?"
#: a mention starts where no letter, digit or dot runs into it; a credential's name may have others before it
PATTERN = rf"(?<![\p{{L}}0-9_.])(?:{EMAIL}|{SECRET}|{IP}|{CARD}|{SSN}|{PHONE}|{NAME})|{ASSIGNED}{VALUE}"
#: a word that may repeat a part of a name
WORD = rf"(?<![\p{{L}}0-9_]){PART}"


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def kind_of(mention: Column) -> Column:
    out = F.lit("name")
    for name, pattern in reversed((("email", EMAIL), ("secret", SECRET), ("ip", IP), ("card", CARD), ("ssn", SSN), ("phone", PHONE))):
        out = F.when(mention.rlike(_whole(pattern)), F.lit(name)).otherwise(out)
    return out


def is_mention(found: Column) -> Column:
    """Whether a match of the pattern is a mention: a number shaped like a card only if its Luhn sum says so."""
    return F.when(found.rlike(_whole(CARD)), _luhn_sum(_digits(found)) % 10 == 0).otherwise(F.lit(True))


def _lead() -> str:
    """What a credential's mention has before its value."""
    return f"^(?:AKIA|{ASSIGNED})"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))


def entities_of(mention: Column, kind: Column) -> Column:
    """Array of (type, canon), one for each part of the mention that is replaced on its own."""
    part = lambda type_, canon: F.struct(type_.alias("type"), canon.alias("canon"))
    words = F.split(mention, " ")
    title = F.regexp_replace(F.get(words, 0), r"\.$", "")
    given = F.when(F.size(words) == 3, F.lower(F.get(words, 1)))
    family = F.lower(F.element_at(words, -1))

    def listed(g: str) -> Column:
        return given.isin(*[n for (x, _), names in GIVEN.items() if x == g for n in names])
    gender = (F.when(title.isin(*FEMALE_TITLES), "f").when(title.isin(*MALE_TITLES), "m")
              .when(listed("f"), "f").when(listed("m"), "m").otherwise("u"))
    named = F.concat(
        F.when(given.isNotNull(), F.array(part(F.concat_ws("|", F.lit("given"), _script(given), gender), given)))
        .otherwise(F.array().cast("array<struct<type:string,canon:string>>")),
        F.array(part(F.concat_ws("|", F.lit("family"), _script(family),
                                 F.when(_script(family) == "latin", F.lit("u")).otherwise(gender)), family)))
    canon = (F.when(kind == "email", F.lower(mention)).when(kind == "phone", F.right(_digits(mention), F.lit(10)))
             .when(kind.isin("card", "ssn"), _digits(mention)).when(kind == "secret", F.regexp_replace(mention, _lead(), ""))
             .otherwise(mention))
    return F.when(kind == "name", named).otherwise(F.array(part(kind, canon)))


# -- draws ----------------------------------------------------------------------
def _stream(size: Column, *parts) -> Column:
    """Hex text of at least 2 * size digits from a keyed hash of the parts."""
    return F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(size / 32).cast("int")),
                                    lambda j: F.sha2(F.concat_ws("|", *parts, j.cast("string")), 256)), "")


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")


def _chosen(options, index: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in options]), index % len(options))


def _shaped(text: Column, stream: Column, hexadecimal: Column | None = None, first: Column | None = None) -> Column:
    """Letters become letters of their case, digits digits, anything else stays."""
    hexadecimal = F.lit(False) if hexadecimal is None else hexadecimal

    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        digit = (b % 10).cast("string")
        if first is not None:
            digit = F.when((i == 0) & first, (2 + b % 8).cast("string")).otherwise(digit)
        return (F.when(hexadecimal & c.rlike("[0-9a-f]"), F.lower(F.hex((b % 16).cast("long"))))
                .when(c.rlike("[0-9]"), digit).when(c.rlike("[a-z]"), F.char(97 + b % 26))
                .when(c.rlike("[A-Z]"), F.char(65 + b % 26)).otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit being the check digit."""
    def add(a: Column, x: Column) -> Column:
        d = x["d"] * F.when(x["i"] % 2 == 0, 1).otherwise(2)
        return a + F.when(d > 9, d - 9).otherwise(d)
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(each, F.lit(0), add)


def candidate(type_: Column, canon: Column, attempt: Column, key: str = KEY) -> Column:
    """The surrogate of an entity at an attempt."""
    def draw(stream: Column) -> Column:
        shaped = _shaped(canon, stream)
        # email: the domain depends on the domain alone, so addresses of one domain keep one
        local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
        labels = F.split(domain, r"\.")
        hosts = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))
        host = F.array_join(F.transform(hosts, lambda x: _shaped(x, _stream(F.length(x), F.lit(key), F.lit("domain"), domain, x))), ".")
        tail = F.when(attempt < 6, F.lit("")).otherwise(F.concat(F.lit("."), F.substring(stream, 1, 12)))
        email = F.concat(_shaped(local, stream), tail, F.lit("@"), F.when(F.size(hosts) > 0, F.concat(host, F.lit("."))).otherwise(""),
                         F.lit("example."), F.element_at(labels, -1))
        secret = _shaped(canon, stream, canon.rlike("^[0-9a-f]+$"))
        octets = F.transform(F.split(canon, r"\."), lambda o, i: let(_byte(stream, i), lambda b: (
            F.when(attempt >= 4, 1 + b % 254).when(F.length(o) == 1, 1 + b % 9).when(F.length(o) == 2, 10 + b % 90)
            .otherwise(100 + b % 155)).cast("string")))
        # the digits that name a card's network stay
        network = F.when(F.length(canon) == 15, 2).when(F.substring(canon, 1, 1) == "2", 4).otherwise(1)
        number = F.concat(F.substring(canon, F.lit(1), network), _shaped(F.substring(canon, network + 1, F.length(canon)), stream))
        body = F.expr("length(canon) - 1")
        bare = F.concat(F.substring(number, F.lit(1), body), F.lit("0"))
        card = F.when(_luhn_sum(canon) % 10 == 0, F.concat(F.substring(number, F.lit(1), body),
                                                           ((10 - _luhn_sum(bare) % 10) % 10).cast("string"))).otherwise(number)
        phone = _shaped(canon, stream, first=F.lit(True))
        out = F.when(type_ == "email", email).when(type_ == "secret", secret).when(type_ == "ip", F.array_join(octets, ".")) \
            .when(type_ == "card", card).when(type_.isin("phone", "ssn"), phone)
        for script, parts in SYLLABLES.items():
            more = F.array_join(F.transform(F.sequence(F.lit(0), 1 + F.floor(attempt / 4).cast("int")),
                                            lambda j: _chosen(parts, _byte(stream, 8 + j))), "")
            for g in "fmu":
                out = out.when(type_ == f"family|{script}|{g}", F.concat(more, F.lit(FAMILY_END[script, g])))
                of = {"f": ["f"], "m": ["m"], "u": ["f", "m"]}[g]
                names = _chosen([n for x in of for n in GIVEN[x, script]], _byte(stream, F.lit(0)))
                ending = _chosen([GIVEN_END[script, x] for x in of], _byte(stream, F.lit(1)))
                out = out.when(type_ == f"given|{script}|{g}", F.when(attempt < 2, names).otherwise(F.concat(more, ending)))
        return out.otherwise(shaped)
    return let(_stream(F.length(canon) + 64, F.lit(key), type_, canon, attempt.cast("string")), draw)


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(type, canon, surrogate) for the distinct rows of ``entities`` (type, canon)."""
    entities = cut(entities.select("type", "canon").distinct())
    given = None
    left = entities.withColumn("attempt", F.lit(0))
    for _ in range(ROUNDS):
        drawn = cut(left.withColumn("surrogate", candidate(F.col("type"), F.col("canon"), F.col("attempt"), key)))
        taken = entities.select("type", F.col("canon").alias("surrogate"))
        if given is not None:
            taken = taken.union(given.select("type", "surrogate"))
        winners = (drawn.groupBy("type", "surrogate").agg(F.min("canon").alias("canon"))
                   .join(taken, ["type", "surrogate"], "left_anti").select("type", "canon", "surrogate"))
        given = cut(winners if given is None else given.union(winners))
        left = cut(drawn.drop("surrogate").join(given, ["type", "canon"], "left_anti").withColumn("attempt", F.col("attempt") + 1))
        if left.isEmpty():
            return given
    raise RuntimeError(f"no free surrogates after {ROUNDS} draws: more entities than their formats can tell apart")


# -- rendering ------------------------------------------------------------------
def _fill(mention: Column, digits: Column) -> Column:
    """The mention with its last digits replaced in their places."""
    before = F.length(_digits(mention)) - F.length(digits)

    def one(c: Column, i: Column) -> Column:
        at = F.length(_digits(F.substring(mention, F.lit(1), i + 1))) - before
        return F.when(c.rlike("[0-9]") & (at > 0), F.substring(digits, at, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(mention, ""), one), "")


def _cased(surrogate: Column, like: Column) -> Column:
    return (F.when((F.length(like) > 1) & (like == F.upper(like)), F.upper(surrogate))
            .when(F.substring(like, 1, 1) != F.lower(F.substring(like, 1, 1)), F.initcap(surrogate)).otherwise(surrogate))


def render(mention: Column, kind: Column, parts: Column) -> Column:
    """A mention with the surrogates ``parts`` of its entities."""
    words = F.split(mention, " ")
    name = F.concat_ws(" ", F.get(words, 0), F.array_join(F.transform(parts, lambda p, i: _cased(p, F.get(words, i + 1))), " "))
    one = F.get(parts, 0)
    return (F.when(kind == "name", name).when(kind.isin("phone", "card", "ssn"), _fill(mention, one))
            .when(kind == "secret", F.concat(F.regexp_extract(mention, _lead(), 0), one))
            .when((kind == "email") & (mention == F.upper(mention)), F.upper(one)).otherwise(one))


def surrogate_map(mentions: DataFrame, key: str = KEY) -> DataFrame:
    """(mention, surrogate) for a frame of distinct mentions."""
    mentions = mentions.withColumn("kind", kind_of(F.col("mention")))
    parts = cut(mentions.select("mention", "kind", F.posexplode(entities_of(F.col("mention"), F.col("kind"))).alias("i", "e"))
                .select("mention", "kind", "i", "e.type", "e.canon"))
    known = parts.join(assign(parts, key), ["type", "canon"])
    whole = known.groupBy("mention", "kind").agg(F.array_sort(F.collect_list(F.struct("i", "surrogate"))).alias("s"))
    return whole.select("mention", render(F.col("mention"), F.col("kind"), F.col("s.surrogate")).alias("surrogate"))


def _known(uses: Column) -> Column:
    """(word, surrogate), lower case, of the parts of all names among a text's uses (mention, surrogate)."""
    names = F.filter(uses, lambda u: u["mention"].rlike(_whole(NAME)))
    pairs = F.transform(names, lambda u: F.slice(F.arrays_zip(
        F.split(F.lower(u["mention"]), " ").alias("word"), F.split(F.lower(u["surrogate"]), " ").alias("surrogate")), 2, 2))
    return F.array_distinct(F.flatten(pairs))


def _repeats(piece: Column, known: Column) -> Column:
    """The piece of a text between mentions with capitalised repeats of a known name's parts replaced."""
    words, keys = F.regexp_extract_all(piece, F.lit(WORD), F.lit(0)), F.transform(known, lambda k: k["word"])

    def swapped(word: Column) -> Column:
        return let(F.array_position(keys, F.lower(word)),
                   lambda at: F.when(at > 0, _cased(F.get(known, at.cast("int") - 1)["surrogate"], word)).otherwise(word))
    done = let(F.transform(words, swapped), lambda w: F.array_join(F.transform(
        F.split(piece, WORD, -1), lambda gap, j: F.concat(gap, F.coalesce(F.get(w, j), F.lit("")))), ""))
    return F.when((F.size(known) > 0) & piece.rlike(WORD), done).otherwise(piece)


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """All columns of ``docs`` (text among them) with mentions replaced, and ``n_mentions``."""
    whole = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])
    at = f"_in{docs.columns.index('text')}"
    found = F.regexp_extract_all(at, F.lit(PATTERN), F.lit(0))
    hit = whole.filter(F.col(at).rlike(PATTERN)).withColumn("_m", found).withColumn("_key", F.md5(F.array_join("_m", "\x01")))
    uses = cut(hit.select("_key", F.posexplode("_m").alias("_i", "mention")).distinct())
    mentions = cut(uses.select("mention").distinct().withColumn("real", is_mention(F.col("mention"))))
    given = surrogate_map(mentions.filter("real").select("mention"), key).union(
        mentions.filter("not real").select("mention", F.col("mention").alias("surrogate")))
    lists = cut(uses.join(given, "mention").groupBy("_key").agg(
        F.array_sort(F.collect_list(F.struct("_i", "surrogate", "mention"))).alias("_s"))
        .select("_key", F.col("_s.surrogate").alias("_s"), _known(F.col("_s")).alias("_known")))
    pieces = F.split(at, PATTERN, -1)
    text = F.array_join(F.transform(pieces, lambda p, i: F.concat(_repeats(p, F.col("_known")), F.coalesce(F.get("_s", i), F.lit("")))), "")
    changed = hit.join(lists, "_key").withColumn("_n", F.size(F.filter("_m", is_mention)).cast("long")).withColumn("_text", text)
    same = whole.filter(~F.coalesce(F.col(at).rlike(PATTERN), F.lit(False))).withColumn("_n", F.lit(0).cast("long"))
    back = lambda df, text: df.select(*[(F.col(text) if c == at else F.col(c)).alias(n)
                                        for c, n in zip(whole.columns, docs.columns)], F.col("_n").alias("n_mentions"))
    return back(changed, "_text").union(back(same, at))


@query("op3_surrogates")
def op3_surrogates(spark, sf_dir):
    return pseudonymise(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))
