"""Personal data: keyed surrogates of the same type, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import P, checked_broadcast, settle

# Forms of address by gender, particles inside names, and syllables and endings of names by script.
MALE = ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Господин", "господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Госпожа", "госпожа", "Κυρία")
EITHER = ("Dr", "Prof")
PARTICLES = "af al bin da de del della den der di dos du ibn la ten ter van von zu".split()
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga ge ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi vo za zo".split(),
    "cyrillic": "ба бе би бо да де ди до фа фе га ге ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то ва ве ви во за зо".split(),
    "greek": "βα βε βι βο δα δε δι δο φα φε γα γε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο τα τε τι το".split(),
}
#: Endings of given names by gender (male, female, unknown) and of surnames.
ENDINGS = {"latin": ("n", "na", "l", "ler"), "cyrillic": ("н", "на", "л", "лер"), "greek": ("ν", "να", "λ", "λος")}
MAN, WOMAN, UNKNOWN, SURNAME = 1, 2, 3, 4

_ADDRESS = "|".join(MALE + FEMALE + EITHER)
_L, _EDGE, _GAP = r"\p{L}", r"(?<![\p{L}\p{N}])", r"[ \x{A0}]"
_NAME = rf"(?!(?:{_ADDRESS})(?!\p{{L}}))\p{{Lu}}[\p{{L}}'’-]++"
#: Particles and initials stand inside a name and stay as they are.
_INSIDE = rf"(?:(?:{'|'.join(PARTICLES)}|\p{{Lu}}\.){_GAP}){{0,4}}"
#: In this order at one place. Every part starts at the edge of a word or number, so that long runs are tried once.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){0,8}\.\p{L}{2,24}",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "iban": _EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "name": _EDGE + rf"(?:(?:{_ADDRESS})\.?{_GAP}){{1,4}}{_INSIDE}{_NAME}(?:{_GAP}{_INSIDE}{_NAME}){{0,64}}",
}
#: Capitalised words in a row: a name only if one of them is known as a given name.
RUN = _EDGE + rf"{_NAME}(?:{_GAP}{_INSIDE}{_NAME}){{1,64}}"
ANY = "|".join(PATTERNS.values())
#: What any text with personal data has: a cheap test that spares the others the patterns.
HINT = rf"[0-9@]|{_EDGE}(?:{_ADDRESS})\.?{_GAP}"


def _matches(pattern: str, v: Column) -> Column:
    return v.rlike(rf"^(?:{pattern})$")


def _kind(m: Column) -> Column:
    digits = F.length(F.regexp_replace(m, r"\D", ""))
    return (
        F.when(m.contains("@"), "email").when(_matches(r"(?:\d{1,3}\.){3}\d{1,3}", m), "ip").when(_matches(r"[A-Z]{2}\d{2}[A-Z0-9 ]+", m), "iban")
        .when(_matches(r"\d{3}-\d{2}-\d{4}", m), "ssn").when(m.rlike(r"^\p{L}"), "name").when((digits >= 13) & ~m.startswith("+"), "card").otherwise("phone")
    )


def _words(m: Column) -> Column:
    """The words of a name as it stands, forms of address included, without the gaps."""
    return F.split(m, _GAP)


def _title(word: Column) -> Column:
    return F.regexp_replace(word, r"\.$", "")


def _first(words: Column, starts: Column) -> Column:
    """Place, from 0, of the first word that belongs to the name: past the forms of address, or the first known given name that is not the last word; else -1."""
    titled = _title(F.element_at(words, 1)).isin(*MALE, *FEMALE, *EITHER)
    past = F.transform(words, lambda w: ~_title(w).isin(*MALE, *FEMALE, *EITHER))
    known = F.transform(words, lambda w, i: F.coalesce(F.array_contains(starts, F.lower(w)), F.lit(False)) & (i < F.size(words) - 1))
    return (F.when(titled, F.array_position(past, True)).otherwise(F.array_position(known, True)) - 1).cast("int")


def _gender(words: Column) -> Column:
    """1 or 2 by the forms of address, 0 without one that tells."""
    signs = F.transform(words, lambda w: F.when(_title(w).isin(*MALE), MAN).when(_title(w).isin(*FEMALE), WOMAN).otherwise(0))
    return F.coalesce(F.try_element_at(F.filter(signs, lambda g: g > 0), F.lit(1)), F.lit(0))


def _named(word: Column, i: Column, first: Column) -> Column:
    """Whether the i-th word is a name: capitalised, no initial, from `first` on."""
    return (first >= 0) & (i >= first) & word.rlike(r"^\p{Lu}") & ~word.endswith(".")


def _canon(m: Column, kind: Column) -> Column:
    """What a mention that is no name refers to, whatever its format."""
    digits = F.regexp_replace(m, r"\D", "")
    return F.when(kind == "email", F.lower(m)).when(kind == "ip", m).when(kind == "iban", F.replace(m, F.lit(" "), F.lit(""))).when(kind == "phone", F.right(digits, F.lit(10))).otherwise(digits)


def _entities(m: Column, starts: Column) -> Column:
    """What a mention refers to, as array<struct<kind, canon, g>>: a name's words each, anything else as one, whatever its format.

    starts are the given names known in this text; g is the gender that the mention tells.
    """

    def name(words: Column) -> Column:
        def of(own: Column) -> Column:
            last = F.size(own) - 1
            return _let(_gender(words), lambda g: F.transform(own, lambda w, i: F.struct(F.when(i == last, "surname").otherwise("given").alias("kind"), F.lower(w).alias("canon"), F.when(i == last, 0).otherwise(g).alias("g"))))

        return _let(_first(words, starts), lambda first: _let(F.filter(words, lambda w, i: _named(w, i, first)), of))

    def entities(kind: Column) -> Column:
        return F.when(kind == "name", _let(_words(m), name)).otherwise(F.array(F.struct(kind.alias("kind"), _canon(m, kind).alias("canon"), F.lit(0).alias("g"))))

    return _let(_kind(m), entities)


def _let(value: Column, then) -> Column:
    """then(value), with value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _stream(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """128 hexadecimal digits that follow from the key and the entity."""
    return _let(F.concat_ws("|", F.lit(key), kind, canon, attempt), lambda seed: F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("|more")), 256)))


def _byte(h: Column, k: Column) -> Column:
    return F.conv(F.substr(h, F.pmod(k, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _chars(v: Column, one) -> Column:
    """v with each character c, of which i is the place from 1, replaced by one(c, i)."""
    every = F.transform(F.sequence(F.lit(1), F.greatest(F.length(v), F.lit(1))), lambda i: _let(F.substr(v, i, F.lit(1)), lambda c: one(c, i)))
    return F.array_join(every, "")


def _recoded(v: Column, h: Column) -> Column:
    """v with every letter and digit replaced by one of its script, case and kind; the k-th from the right depends on h and k alone."""

    def one(c: Column, i: Column) -> Column:
        alphabet = (
            F.when(c.rlike("[0-9]"), "0123456789").when(c.rlike(r"\p{IsCyrillic}"), "абвгдежзиклмнопрстуфхцчшэюя").when(c.rlike(r"\p{IsGreek}"), "αβγδεζηθικλμνξοπρστυφχψω")
            .when(c.rlike(r"\p{Lu}"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").when(c.rlike(_L), "abcdefghijklmnopqrstuvwxyz").otherwise(c)
        )
        return _let(alphabet, lambda a: F.substr(a, F.pmod(_byte(h, F.length(v) - i), F.greatest(F.length(a), F.lit(1))) + 1, F.lit(1)))

    return _chars(v, one)


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10."""
    n = F.length(digits)

    def add(a: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return a + F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.pmod(F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add), F.lit(10))


def _by_script(v: Column, table: dict) -> Column:
    """The array of strings that table has for v's script."""
    cyrillic, greek, latin = (F.split(F.lit(" ".join(table[x])), " ") for x in ("cyrillic", "greek", "latin"))
    return F.when(v.rlike(r"\p{IsCyrillic}"), cyrillic).when(v.rlike(r"\p{IsGreek}"), greek).otherwise(latin)


def _name(canon: Column, gender: Column, h: Column) -> Column:
    """Four syllables and the ending of the gender, in the script of canon."""

    def syllable(table: Column, k: int) -> Column:
        return F.element_at(table, F.pmod(_byte(h, F.lit(2 * k)) * 256 + _byte(h, F.lit(2 * k + 1)), F.size(table)) + 1)

    return _let(_by_script(canon, SYLLABLES), lambda table: F.concat(*[syllable(table, k) for k in range(4)], F.element_at(_by_script(canon, ENDINGS), gender)))


def name_surrogate(key: str, kind: Column, canon: Column, attempt: Column, gender: Column) -> Column:
    """The canonical surrogate of a given name or, with SURNAME as gender, of a surname."""
    return _let(_stream(key, kind, canon, attempt), lambda h: _name(canon, gender, h))


def canonical_surrogate(key: str, kind: Column, canon: Column, attempt: Column, gender: Column) -> Column:
    """The surrogate of an entity in canonical form; two mentions of an entity differ from it in format alone. gender is SURNAME for surnames."""

    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    top = F.regexp_extract(domain, r"\.[^.]*$", 0)

    def email(new: Column, h: Column) -> Column:
        host = _let(_stream(key, F.lit("domain"), domain, F.lit(0)), lambda d: _recoded(F.regexp_replace(domain, r"\.[^.]*$", ""), d))
        # A short local part has too few surrogates for all distinct ones, so it is lengthened.
        tail = F.when(F.length(local) < 12, F.translate(F.right(h, F.lit(8)), "0123456789", "ghijklmnop")).otherwise("")
        return F.concat(new, tail, F.lit("@"), host, top)

    def ip(h: Column) -> Column:
        return F.concat_ws(".", _byte(h, F.lit(0)) % 223 + 1, *[_byte(h, F.lit(k)) for k in (1, 2, 3)])

    def card(new: Column) -> Column:
        body = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(new, F.lit(2), F.length(new) - 2))
        check = _let(F.concat(body, F.lit("0")), lambda d: F.pmod(10 - _luhn(d), F.lit(10)).cast("string"))
        return F.concat(body, F.when(_luhn(canon) == 0, check).otherwise(F.right(new, F.lit(1))))

    def made(h: Column) -> Column:
        own = F.when(kind == "email", local).when(kind == "iban", F.substr(canon, F.lit(3))).otherwise(canon)
        return _let(_recoded(own, h), lambda new: (
            F.when(kind == "email", email(new, h)).when(kind == "ip", ip(h)).when(kind == "card", card(new)).when(kind == "iban", F.concat(F.substr(canon, F.lit(1), F.lit(2)), new)).otherwise(new)
        ))

    return F.when(kind.isin("given", "surname"), name_surrogate(key, kind, canon, attempt, gender)).otherwise(_let(_stream(key, kind, canon, attempt), made))


def _in_format(m: Column, sign: str, new: Column) -> Column:
    """m with its characters of class `sign` replaced, from the right, by those of new; what is left over stays."""

    def one(c: Column, i: Column) -> Column:
        def placed(k: Column) -> Column:
            return F.when(c.rlike(f"[{sign}]") & (k <= F.length(new)), F.substr(new, F.length(new) - k + 1, F.lit(1))).otherwise(c)

        return _let(F.length(F.regexp_replace(F.substr(m, i), f"[^{sign}]", "")), placed)

    return _chars(m, one)


def _cased(m: Column, new: Column) -> Column:
    first = F.substr(m, F.lit(1), F.lit(1))
    title = F.concat(F.upper(F.substr(new, F.lit(1), F.lit(1))), F.substr(new, F.lit(2)))
    return F.when((F.upper(m) == m) & (F.lower(m) != m) & (F.length(m) > 1), F.upper(new)).when(F.lower(first) != first, title).otherwise(new)


def surrogate(key: str, m: Column, codes: Column, starts: Column) -> Column:
    """What replaces the mention m; codes maps "kind:canon" to attempt * 4 + gender of the entities that cannot be told from the mention alone."""

    def code(kind: Column, canon: Column) -> Column:
        return F.coalesce(F.try_element_at(codes, F.concat_ws(":", kind, canon)), F.lit(0))

    def name(words: Column) -> Column:
        first, gender = _first(words, starts), _gender(words)

        def written(place: Column) -> Column:
            def one(word: Column, i: Column) -> Column:
                kind, canon = F.when(i == place["last"], "surname").otherwise("given"), F.lower(word)

                def made(c: Column) -> Column:
                    told = F.when(i == place["last"], SURNAME).when(c % 4 > 0, (c % 4).cast("int")).when(place["gender"] > 0, place["gender"]).otherwise(UNKNOWN)
                    return _cased(word, name_surrogate(key, kind, canon, F.floor(c / 4).cast("int"), told))

                return F.when(_named(word, i, place["first"]), _let(code(kind, canon), made)).otherwise(word)

            # Gaps come back as they were.
            gaps = F.concat(F.regexp_extract_all(m, F.lit(_GAP), 0), F.array(F.lit("")))
            return F.when(place["first"] < 0, m).otherwise(F.array_join(F.zip_with(F.transform(words, one), gaps, lambda w, g: F.concat(w, g)), ""))

        def placed(at: Column) -> Column:
            last = F.array_max(F.transform(words, lambda w, i: F.when(_named(w, i, at["first"]), i)))
            return _let(F.struct(at["first"].alias("first"), at["gender"].alias("gender"), last.alias("last")), written)

        return _let(F.struct(first.alias("first"), gender.alias("gender")), placed)

    def other(e: Column) -> Column:
        def written(new: Column) -> Column:
            return F.when(e["kind"] == "email", _cased(m, new)).when(e["kind"] == "ip", new).when(e["kind"] == "iban", _in_format(m, "A-Z0-9", new)).otherwise(_in_format(m, "0-9", new))

        return _let(canonical_surrogate(key, e["kind"], e["canon"], F.floor(code(e["kind"], e["canon"]) / 4).cast("int"), F.lit(0)), written)

    def any_kind(kind: Column) -> Column:
        return F.when(kind == "name", _let(_words(m), name)).otherwise(_let(F.struct(kind.alias("kind"), _canon(m, kind).alias("canon")), other))

    return _let(_kind(m), any_kind)


def settle_attempts(entities: DataFrame, key: str, rounds: int = 64) -> DataFrame:
    """Entities (kind, canon, gender) with the attempt whose surrogate no other entity has and no real entity is; settled.

    Given names and surnames are told apart by what is written, not by kind. If after so many rounds some still collide, their
    formats have too few surrogates for so many entities (a phone number of 5 digits has 100,000), and an error names the kinds.
    """
    group = F.when(F.col("kind").isin("given", "surname"), "name").otherwise(F.col("kind"))
    now = settle(entities.withColumn("attempt", F.lit(0)), "entities")
    real = entities.select(group.alias("group"), F.col("canon").alias("new"), F.lit(True).alias("real")).distinct()
    gender = F.when(F.col("kind") == "surname", SURNAME).otherwise(F.col("gender"))
    made = canonical_surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt"), gender)
    rank = F.row_number().over(Window.partitionBy("group", "new").orderBy("attempt", "kind", "canon"))
    for _ in range(rounds):
        new = now.withColumns({"group": group, "new": made})
        checked = new.withColumn("rank", rank).join(real, ["group", "new"], "left")
        again = (F.col("rank") > 1) | F.coalesce("real", F.lit(False))
        moved = settle(checked.select("kind", "canon", "gender", (F.col("attempt") + again.cast("int")).alias("attempt"), again.alias("again")), "entities")
        now = moved.drop("again")
        left = moved.filter("again").select("kind").distinct().limit(10).collect()
        if not left:
            return now
    raise RuntimeError(f"too few surrogates for the distinct entities of: {', '.join(sorted(r[0] for r in left))}")


def replace_pii(docs: DataFrame, key: str, broadcast_rows: int = 100_000, text_col: str = "text") -> DataFrame:
    """docs with every mention of personal data in text_col replaced by a surrogate, and n_replaced (long).

    Found are e-mail and IPv4 addresses, IBANs, social security, phone and card numbers (13 to 19 digits), names after a form
    of address, and runs of two capitalised words or more from the first one on that the corpus knows as a given name, that is,
    holds somewhere between a form of address and a surname. Particles and initials inside a name stay. A single name without
    a form of address stays, and a run of more than 65 capitalised words is several.

    A surrogate follows from the key and the entity alone: it has the mention's format, letters' script and case, cards keep
    their first digit and a valid check digit, phones what precedes the last ten digits. A given name's surrogate has the
    gender that most documents tell by a form of address (of equals, male; unknown without one). So one entity has one
    surrogate in all documents, in whatever format and after whatever form of address it is written.

    Distinct entities are gathered (never mentions or texts) and their surrogates checked: of two with the same surrogate, and
    where a surrogate is a real entity, one tries again. Only those, entities whose mentions disagree on the gender, and given
    names in runs are looked up; every other document is rewritten where it lies, from its own text.

    Null text stays null, with 0 replaced; empty text stays; texts of any length are read whole; all columns, null ids and
    repeated rows stay (a column n_replaced is replaced); an empty table gives no rows. Texts without personal data stay as
    they are. More entities of one format than it has surrogates are an error that names the kind.
    """
    text, hashed, no_names = F.col(text_col), F.sha2(F.col(text_col), 256), F.array().cast("array<string>")

    def found(pattern: str, hint: str) -> Column:
        return F.when(text.rlike(hint), F.regexp_extract_all(text, F.lit(pattern), 0))

    def of_texts(df: DataFrame, mentions: Column, starts: Column) -> DataFrame:
        every = F.array_distinct(F.flatten(F.transform(mentions, lambda m: _entities(m, starts))))
        return df.select(hashed.alias(P + "t"), F.explode(every).alias("e")).select(P + "t", "e.kind", "e.canon", "e.g")

    pattern, hint, rows, starts = ANY, HINT, docs.drop("n_replaced"), no_names
    titled = of_texts(rows, found(ANY, HINT), no_names).groupBy("kind", "canon")
    told = [F.count_if(F.col("g") == g).alias(f"g{g}") for g in (0, MAN, WOMAN)]
    entities = settle(titled.agg(*told), "pii")
    given = entities.filter("kind = 'given'").select("canon")
    if not given.isEmpty():
        # Runs of capitalised words in which one, not the last, is known as a given name: these names, by text.
        pattern, hint = f"{ANY}|{RUN}", f"{HINT}|{RUN}"
        mentions = found(pattern, hint)
        words = F.flatten(F.transform(mentions, lambda m: F.transform(_words(m), F.lower)))
        known = rows.select(hashed.alias(P + "t"), F.explode(F.array_distinct(words)).alias("canon")).distinct().join(given, "canon")
        known = settle(known.groupBy(P + "t").agg(F.collect_set("canon").alias(P + "starts")), "pii-given")
        rows = rows.withColumn(P + "t", hashed).join(checked_broadcast(known, broadcast_rows), P + "t", "left").drop(P + "t")
        starts = F.coalesce(F.col(P + "starts"), no_names)
        entities = settle(of_texts(rows, mentions, starts).groupBy("kind", "canon").agg(*told), "pii")
    gender = F.when(F.col("g1") + F.col("g2") == 0, UNKNOWN).when(F.col("g1") >= F.col("g2"), MAN).otherwise(WOMAN)
    signs = sum((F.col(f"g{g}") > 0).cast("int") for g in (0, MAN, WOMAN))
    entities = entities.withColumn("gender", F.when(F.col("kind") == "given", gender).otherwise(0)).withColumn("mixed", signs > 1)
    tried = settle_attempts(entities.select("kind", "canon", "gender"), key)
    codes = tried.join(entities.select("kind", "canon", "mixed"), ["kind", "canon"]).filter("attempt > 0 or mixed")
    codes = settle(codes.select("kind", "canon", (F.col("attempt") * 4 + F.col("gender")).alias("code")), "pii-codes")
    wide = rows.withColumn(P + "m", found(pattern, hint))
    if codes.isEmpty():
        wide = wide.withColumn(P + "codes", F.lit(None).cast("map<string,int>"))
    else:
        own = of_texts(rows, found(pattern, hint), starts).select(P + "t", "kind", "canon").distinct().join(codes, ["kind", "canon"])
        own = own.groupBy(P + "t").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws(":", "kind", "canon"), "code"))).alias(P + "codes"))
        wide = wide.withColumn(P + "t", F.when(F.size(P + "m") > 0, hashed)).join(checked_broadcast(settle(own, "pii-again"), broadcast_rows), P + "t", "left")
    pieces, new = F.split(text, pattern, -1), F.transform(P + "m", lambda m: surrogate(key, m, F.col(P + "codes"), starts))
    n = F.coalesce(F.size(F.filter(P + "m", lambda m: F.size(_entities(m, starts)) > 0)), F.lit(0)) if pattern != ANY else F.coalesce(F.size(P + "m"), F.lit(0))
    joined = F.array_join(F.zip_with(pieces, new, lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")
    wide = wide.withColumn(P + "n", F.greatest(n, F.lit(0)).cast("long")).withColumn(P + "out", F.when(F.col(P + "n") > 0, joined).otherwise(text))
    return wide.select(*[F.col(P + "out").alias(text_col) if c == text_col else F.col(c) for c in docs.columns if c != "n_replaced"], F.col(P + "n").alias("n_replaced"))


__all__ = ["canonical_surrogate", "replace_pii", "settle_attempts", "surrogate"]
