"""Surrogates for personal data, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.workspace import Workspace

#: Titles that mark a person's name, with the gender they tell (u: not told) in lower case.
TITLES = {
    "mr": "m", "mrs": "f", "ms": "f", "miss": "f", "sir": "m", "madam": "f", "dr": "u", "prof": "u",
    "herr": "m", "frau": "f", "monsieur": "m", "madame": "f", "mademoiselle": "f", "señor": "m", "señora": "f", "señorita": "f",
    "господин": "m", "госпожа": "f", "κύριος": "m", "κυρία": "f",
}
_TITLE = "|".join(sorted((t[0].upper() + t[1:] for t in TITLES), key=lambda t: (-len(t), t)))
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Kinds of entities in the order in which they are tried. Repetitions of groups are bounded: the matcher's stack grows
#: with them, and a domain name has at most 127 labels. A name is taken whole, however long.
PATTERNS = {
    "email": r"[A-Za-z0-9_%+-](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,126}[A-Za-z]{2,24}",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|(?=[0-9a-f]{0,31}[0-9])[0-9a-f]{32,64})(?![A-Za-z0-9])",
    "person": rf"(?<![\p{{L}}])(?:{_TITLE})\.?[ ]\p{{Lu}}[\p{{L}}'’-]++(?:[ ]\p{{Lu}}[\p{{L}}'’-]++){{0,2}}",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these has no entity; it isn't searched further. Every match of every pattern holds one of
#: these: two digits with at most a space, dot or hyphen between them (ip, ssn, phone, card), @, AKIA, 32 hex digits or a title.
_HINT = rf"[0-9][ .-]?[0-9]|@|AKIA|(?:{_TITLE})\.?[ ]\p{{Lu}}|[0-9a-f]{{32}}"
ATTEMPTS = 20
#: A character that texts hardly hold (never assigned); it marks matches. Texts with it are taken apart by two searches.
MARK = "\ufdd0"
#: Syllables that surrogate names are built from: script, then consonants and vowels.
_SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδζκλμνπρστ", "αεηιο")}
#: Endings of names by gender. A base ends in a vowel and has an even number of letters, so that no two bases give equal names.
_ENDS = {("latin", "f"): "a", ("latin", "m"): "n", ("cyrillic", "f"): "а", ("cyrillic", "m"): "в", ("greek", "f"): "α", ("greek", "m"): "ς"}
_LETTERS = [("^[0-9]$", "0123456789"), ("^[a-z]$", "abcdefghijklmnopqrstuvwxyz"), ("^[A-Z]$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")]
_DIGITS = _LETTERS[:1]


def parts_of(text: Column) -> Column:
    """[gap, mention, gap, mention, ..., gap] of a text, from one search; null without a hint of an entity."""
    marked = F.split(F.regexp_replace(text, f"({_ANY})", f"{MARK}$1{MARK}"), MARK, -1)
    found, gaps = F.regexp_extract_all(text, F.lit(f"({_ANY})"), F.lit(1)), F.split(text, _ANY, -1)
    twice = F.flatten(F.zip_with(gaps, found, lambda g, m: F.when(m.isNull(), F.array(g)).otherwise(F.array(g, m))))
    return F.when(text.rlike(_HINT), F.when(F.contains(text, F.lit(MARK)), twice).otherwise(marked))


def kind_of(mention: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _title(mention: Column) -> Column:
    return F.regexp_extract(mention, rf"^(?:{_TITLE})\.?[ ]", 0)


def pieces_of(kind: Column, mention: Column) -> Column:
    """The entities of a mention: array of (kind, ident, shown, rest).

    A person's last word is a surname and those before are given names, each an entity of
    its own: "Mr Smith" and "Mr John Smith" share the surname's replacement, in a text and
    across texts, and "Mrs Jane Smith" its base. A possessive or a mark at the end of a word is its rest. Mentions of one
    entity have one ident: case doesn't tell names and emails apart, digit grouping doesn't
    tell numbers apart, nor does a country code phone numbers.
    """
    digits = F.regexp_replace(mention, "[^0-9]", "")
    ident = F.when(kind == "phone", F.right(digits, F.lit(10))).when(kind.isin("card", "ssn"), digits).when(kind == "email", F.lower(mention)).otherwise(mention)
    words = F.split(F.substr(mention, F.length(_title(mention)) + 1), " ")
    ends = "(?:['’]s|['’-]+)$"

    def word(w: Column, i: Column) -> Column:
        bare = F.regexp_replace(w, ends, "")
        return F.struct(F.when(i == F.size(words) - 1, "surname").otherwise("given").alias("kind"), F.lower(bare).alias("ident"), bare.alias("shown"), F.regexp_extract(w, ends, 0).alias("rest"))

    one = F.struct(kind.alias("kind"), ident.alias("ident"), mention.alias("shown"), F.lit("").alias("rest"))
    return F.when(kind == "person", F.transform(words, word)).otherwise(F.array(one))


def _stream(key: str, kind: Column, ident: Column, attempt: int) -> Column:
    """Hex digits that only the key's owner can foretell: numbers for each character of ident and 64 more."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, ident, F.lit(str(attempt)))
    blocks = F.sequence(F.lit(0), F.floor((F.length(ident) + 64) / 16).cast("int"))
    return F.array_join(F.transform(blocks, lambda i: F.sha2(F.concat(seed, F.lit("\x1e"), i.cast("string")), 256)), "")


def _number(stream: Column, i: Column) -> Column:
    """The i-th number below 65536 of the stream."""
    return F.conv(F.substr(stream, (i * 4).cast("int") + 1, F.lit(4)), 16, 10).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substr(F.lit(alphabet), F.pmod(n, F.lit(len(alphabet))) + 1, F.lit(1))


def _shape(text: Column, stream: Column, alphabets: list[tuple[str, str]]) -> Column:
    """Each character that a class matches becomes another of the class; the rest stays."""

    def one(c: Column, i: Column) -> Column:
        n, out = _number(stream, i), c
        for match, alphabet in reversed(alphabets):
            out = F.when(c.rlike(match), _pick(alphabet, n)).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(body: Column) -> Column:
    """The check digit of a card number without one."""
    digits = F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(i % 2 == 0, F.floor(c.cast("int") * 2 / 10) + (c.cast("int") * 2) % 10).otherwise(c.cast("int")).cast("int"))
    return ((10 - F.aggregate(digits, F.lit(0), lambda s, d: s + d) % 10) % 10).cast("string")


def script_of(ident: Column) -> Column:
    return F.when(ident.rlike(r"\p{IsCyrillic}"), "cyrillic").when(ident.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _name(ident: Column, stream: Column, attempt: int) -> Column:
    """The base of a name: three syllables, four for a long word, one more after every three attempts."""
    out = None
    for script, (consonants, vowels) in _SYLLABLES.items():
        syllable = lambda j: F.concat(_pick(consonants, _number(stream, F.lit(2 * j))), _pick(vowels, _number(stream, F.lit(2 * j + 1))))  # noqa: B023, E731
        made = F.concat(*(syllable(j) for j in range(3 + attempt // 3)), F.when(F.length(ident) > 6, syllable(20)).otherwise(F.lit("")))
        out = made if out is None else F.when(script_of(ident) == script, made).otherwise(out)
    return out


def _ending(script: Column, gender: Column) -> Column:
    out = F.lit("")
    for (s, g), end in _ENDS.items():
        out = F.when((script == s) & (gender == g), F.lit(end)).otherwise(out)
    return out


def surrogate(key: str, kind: Column, ident: Column, attempt: int) -> Column:
    """The replacement of an entity in its plain form, under one attempt of the keyed stream."""
    stream = _stream(key, kind, ident, attempt)
    number = lambda i: _number(stream, F.lit(i))
    longer = F.concat(*(_pick("abcdefghijklmnopqrstuvwxyz", _number(stream, F.length(ident) + i)) for i in range(6))) if attempt >= 3 else F.lit("")  # short ones run out of others of their length
    address = _shape(F.regexp_replace(ident, r"\.[^.]+$", ""), stream, _LETTERS)
    email = F.concat(F.substring_index(address, "@", 1), longer, F.lit("@"), F.substring_index(address, "@", -1), F.lit(".example"))
    ip = F.concat_ws(".", *((number(i) % 254 + 1).cast("string") for i in range(4)))
    phone = F.concat(_pick("23456789", number(63)), F.substr(_shape(ident, stream, _DIGITS), F.lit(2)))
    card = F.concat(F.substr(ident, F.lit(1), F.lit(1)), _shape(F.substr(ident, F.lit(2), F.length(ident) - 2), stream, _DIGITS))
    secret = F.when(ident.startswith("AKIA"), F.concat(F.lit("AKIA"), _shape(F.substr(ident, F.lit(5)), stream, [("^[0-9]$", "234567"), _LETTERS[2]]))).otherwise(_shape(ident, stream, [_LETTERS[0], ("^[a-f]$", "abcdef")]))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "phone", phone)
        .when(kind == "card", F.concat(card, _luhn(card)))
        .when(kind == "ssn", _shape(ident, stream, _DIGITS))
        .when(kind == "secret", secret)
        .otherwise(_name(ident, stream, attempt))
    )


def _written_like(kind: Column, shown: Column, plain: Column, gender: Column) -> Column:
    """The replacement in the mention's own form: digit grouping and digits before the replaced ones, case, gender of a name."""
    places = F.transform(F.sequence(F.lit(1), F.length(shown)), lambda i: F.length(F.regexp_replace(F.substr(shown, i), "[^0-9]", "")))  # digits from here on
    grouped = F.array_join(F.zip_with(F.split(shown, ""), places, lambda c, n: F.when(c.rlike("^[0-9]$") & (n <= F.length(plain)), F.substr(plain, F.length(plain) - n + 1, F.lit(1))).otherwise(c)), "")
    shouted = (shown == F.upper(shown)) & (shown != F.lower(shown))
    like = lambda c, x: F.array_join(F.transform(F.split(c, ""), lambda l, i: F.when(F.substr(x, i + 1, F.lit(1)).rlike("^[A-Z]$"), F.upper(l)).otherwise(l)), "")
    half = lambda c, side: F.substring_index(F.regexp_replace(c, r"\.[^.]+$", ""), "@", side)
    email = F.when(shouted, F.upper(plain)).otherwise(F.concat(like(half(plain, 1), half(shown, 1)), F.lit("@"), like(half(plain, -1), half(shown, -1)), F.lit(".example")))
    full = F.concat(plain, _ending(script_of(F.lower(shown)), gender))
    name = F.when(shouted & (F.length(shown) > 1), F.upper(full)).otherwise(F.concat(F.upper(F.substr(full, F.lit(1), F.lit(1))), F.substr(full, F.lit(2))))
    return F.when(kind.isin("phone", "card", "ssn"), grouped).when(kind.isin("given", "surname"), name).when(kind == "email", email).otherwise(plain)


def _forms(kind: Column, ident: Column, plain: Column) -> Column:
    """All that a replacement may be written as, in lower case."""
    script = script_of(ident)
    gendered = F.array(plain, *(F.concat(plain, _ending(script, F.lit(g))) for g in ("m", "f")))
    return F.when(kind.isin("given", "surname"), gendered).otherwise(F.array(F.lower(plain)))


def resolve(entities: DataFrame, key: str, ws: Workspace) -> DataFrame:
    """(kind, ident, plain): distinct entities (kind, ident) with distinct replacements, none of which is a real entity.

    Every entity gets attempt 0; within equal replacements the smallest identity keeps it,
    the others and those that met a real entity try again. Names meet names of both kinds,
    in every form that a gender gives them. Each check is a grouping or a semi-join of
    entities, never of mentions.
    """
    tried = lambda df, a: df.withColumn("plain", surrogate(key, F.col("kind"), F.col("ident"), a))
    sort = lambda c: F.when(F.col(c).isin("given", "surname"), "name").otherwise(F.col(c))
    now = ws.write(tried(entities, 0), "surrogates-0")
    entities = now.select("kind", "ident")
    real = entities.select(sort("kind").alias("sort"), F.lower("ident").alias("form"))  # case doesn't tell entities apart
    for attempt in range(1, ATTEMPTS + 1):
        winners = now.groupBy("kind", F.lower("plain").alias("form")).agg(F.count("*").alias("n"), F.min("ident").alias("first"))
        doubles = now.withColumn("form", F.lower("plain")).join(winners.filter("n > 1"), ["kind", "form"]).filter("ident <> first").select("kind", "ident")
        shown = now.select("kind", "ident", sort("kind").alias("sort"), F.explode(_forms(F.col("kind"), F.col("ident"), F.col("plain"))).alias("form"))
        met = shown.join(real, ["sort", "form"], "left_semi").select("kind", "ident")
        again = ws.write(doubles.unionByName(met).distinct(), f"again-{attempt}")
        if again.isEmpty():
            return now
        now = ws.write(now.join(again, ["kind", "ident"], "left_anti").unionByName(tried(entities.join(again, ["kind", "ident"], "left_semi"), attempt)), f"surrogates-{attempt}")
    raise ValueError("too many entities of one format for distinct replacements")


def _gendered(pieces: DataFrame) -> DataFrame:
    """pieces with gender: that of the mention's title; where it tells none, that of all other mentions of the name, if they agree."""
    told = F.lower(F.regexp_extract("mention", rf"^({_TITLE})", 1))
    own = F.coalesce(F.create_map(*(F.lit(x) for kv in TITLES.items() for x in kv))[told], F.lit("u"))
    pieces = pieces.withColumn("own", own)
    known = pieces.filter("kind in ('given', 'surname') and own <> 'u'").groupBy("kind", "ident").agg(F.min("own").alias("known"), F.max("own").alias("most")).filter("known = most").drop("most")
    return pieces.join(known, ["kind", "ident"], "left").withColumn("gender", F.when(F.col("own") != "u", F.col("own")).otherwise(F.coalesce("known", F.lit("u")))).drop("own", "known")


def replace_entities(docs: DataFrame, *, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with personal data in text_col replaced, and n_entities: how many mentions were.

    Emails, IPv4 addresses, social security numbers, phone and card numbers, access keys
    and names after a title are found by pattern; where patterns overlap the first in the
    text, and then in PATTERNS, wins. The same entity gets the same replacement everywhere
    and no two entities share one (see pieces_of and resolve). Replacements keep the
    format of each mention: as many characters of the same classes (an email's top domain
    becomes .example, and emails or names that have run out of free ones get longer), a
    card's check digit, a phone number's country code, the title, script and case of a
    name. Names have one base everywhere, and an ending that tells the gender of the
    mention's title; where the title tells none, that of the name's other mentions if they
    agree, and no ending if not.

    Each text is searched once and written with its matches cut out; distinct texts'
    mentions meet their replacements, and the texts are put together by position. A null
    text stays null with 0 entities, as an empty one does; texts of any length are searched
    whole, and the search's stack is bounded. Null ids and repeated rows stay; an empty
    table stays empty. All columns of docs are kept whatever their names, except that one
    named n_entities is replaced. id_col isn't looked at.
    """
    ws = Workspace(docs.sparkSession, "pii")
    rows = docs.drop("n_entities")
    own = "__pii"
    while any(c.lower().startswith(own) for c in rows.columns):
        own += "_"
    parts, digest, lists_key, put = (f"{own}_{x}" for x in ("parts", "digest", "key", "put"))
    cut = rows.withColumn(parts, parts_of(F.col(text_col))).withColumn(parts, F.when(F.size(parts) > 1, F.col(parts)))
    cut = cut.withColumn(digest, F.when(F.col(parts).isNotNull(), F.unhex(F.sha2(text_col, 256))))
    cut = ws.write(cut.withColumn(text_col, F.when(F.col(parts).isNull(), F.col(text_col))), "cut")

    touched = cut.filter(F.col(parts).isNotNull())
    mentions = touched.select(F.col(digest).alias("digest"), F.posexplode(F.filter(parts, lambda x, i: i % 2 == 1)).alias("pos", "mention")).distinct()
    names = mentions.select("mention").distinct().withColumn("kind", F.coalesce(kind_of(F.col("mention")), F.lit("secret")))
    pieces = names.select("mention", F.posexplode(pieces_of(F.col("kind"), F.col("mention"))).alias("i", "x")).select("mention", "i", "x.*")
    pieces = ws.write(_gendered(pieces), "pieces")
    plain = resolve(pieces.select("kind", "ident").distinct(), key, ws)
    shown = F.concat(_written_like(F.col("kind"), F.col("shown"), F.col("plain"), F.col("gender")), F.col("rest"))
    written = pieces.join(plain, ["kind", "ident"]).groupBy("mention").agg(F.sort_array(F.collect_list(F.struct("i", shown.alias("as")))).alias("all"))
    written = written.select("mention", F.concat(_title(F.col("mention")), F.array_join(F.col("all.as"), " ")).alias("as"))
    lists = mentions.join(ws.write(written, "written"), "mention").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("pos", "as"))).alias("all"))
    lists = ws.write(lists.select(F.col("digest").alias(lists_key), F.col("all.as").alias(put)), "lists")

    done = touched.join(lists, F.col(digest) == F.col(lists_key))
    text = F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.get(put, F.floor(i / 2).cast("int"))).otherwise(x)), "")
    keep = [F.col(f"`{c}`") for c in rows.columns]
    done = done.withColumn("n_entities", F.size(put).cast("bigint")).withColumn(text_col, text).select(*keep, "n_entities")
    return done.unionByName(cut.filter(F.col(parts).isNull()).select(*keep, F.lit(0).cast("bigint").alias("n_entities")))
