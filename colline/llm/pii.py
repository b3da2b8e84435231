"""PII (operator 8): detected entities get keyed surrogates of their own kind.

Detection is one regular expression.  Every match has one or more entities (a
titled name has its given names and, last, a family name), each with a kind and
a canonical form, so that spellings of one entity agree: lower-cased mail addresses, the
digits of a phone number, hexadecimal secrets in small letters.

A surrogate is drawn for each distinct entity of the whole corpus from a keyed
hash: digits stay digits, letters stay letters of their script, names follow
the title's gender and their script, mail domains and IP addresses come from
reserved ranges.  Secrets are taken whole, of any length (up to a space or quote;
hexadecimal ones to their last digit), and the hash grows with them.  Draws are
checked: a surrogate that another entity holds, or that is itself an entity of
the corpus, is drawn again, until all are distinct.  So equal entities have
equal surrogates everywhere and different ones differ.

Names are found by their titles.  The words of the names of a document are then
looked up in the rest of that document: a whole word that starts with a capital
and equals one of them gets the same surrogate, with or without a possessive
ending.  A title that tells no gender takes that of the same given name with
another title in the document, if there is one.

The expression runs once over every text; texts and matches are written to the
shared folder.  Texts are cut at the matches and put together again; only
documents with a match are joined to their surrogates, by a hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colline.llm.common import save

# Titles by the gender they tell.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "госпожа")
OTHER_TITLES = ("Dr", "Prof", "Doctor", "Professor", "Doktor", "Docteur", "Professeur", "Doctora", "доктор", "профессор")
# Alphabets by script, small letters; letters of scripts not listed become Latin ones.
LATIN = "abcdefghijklmnopqrstuvwxyz"
LETTERS = {
    "Cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя",
    "Greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "Armenian": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփք",
    "Georgian": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ",
    "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "Devanagari": "कखगघचछजझटठडढतथदधनपफबभमयरलवशसह",
    "Thai": "กขคงจฉชซดตถทธนบปผพฟมยรลวสหอ",
    "Han": "安白北成大东方高光海和江金李林明南平青山石水天王文西小新元中",
    "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ",
    "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ",
    "Hangul": "가나다라마바사아자차카타파하고노도로모보소오조초코토포호",
}
# Sounds that names are made of.
SOUNDS = {
    "latin": ("ba be bi bo da de di do fa fe ga ge go ka ke ki la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi".split()),
    "cyrillic": ("ба бе бо ва ве ви га да де ди за зе ка ки ла ле ли ма ме ми на не ни па пе ра ре ри ро са се си та те ти".split()),
    "greek": ("βα βε γα γε δα δε δι ζα ζε θα θε κα κε κι λα λε λι μα με μι να νε νι πα πε ρα ρε σα σε σι τα τε τι φα φι".split()),
}
ENDINGS = {
    "latin": {"given_m": "n rd s er ck".split(), "given_f": "na lla ra ssa lia".split(), "given_n": "ri lin el".split(), "family": "sen man ley ton berg".split()},
    "cyrillic": {"given_m": "н л р мир слав".split(), "given_f": "на ла ра ля ся".split(), "given_n": "ша ня".split(), "family": "нко чук дзе вич ко".split()},
    "greek": {"given_m": "νος ρης λος κος".split(), "given_f": "να λια ρα σσα".split(), "given_n": "ι υ".split(), "family": "ίδης άκης όγλου ίου έας".split()},
}

# One or more titles with the spaces after them.
_TITLES = rf"(?:(?:{'|'.join(sorted(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES, key=len, reverse=True))})\.?[ ])++"
# What an entity's own word leaves out at its end.
_ENDING = r"(?:['’]s|['’\-]+)$"
# A word of a text, or what is between two words.
_TOKENS = r"[\p{L}\p{M}\p{N}]+(?:['’\-]+[\p{L}\p{M}\p{N}]+)*+|[^\p{L}\p{M}\p{N}]++"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|\d{1,2})"
# The forms that are looked for, by kind; the first that fits names the kind.
FORMS = {
    "email": r"[\p{L}\p{N}._%+\-]{1,64}+@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "secret": r"(?i:token|secret|password|passwd|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{8,}+",
    "hex": r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\p{N}])",
    "ip": rf"(?<!\d\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ssn": r"\d{3}-\d{2}-\d{4}(?!\d)",
    "phone": r"(?:\+\d{1,3}[ .\-]?\(?\d{1,4}\)?(?:[ .\-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?!\d)",
    "card": r"(?:\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{4,5})(?!\d)",
    "name": _TITLES + r"\p{Lu}[\p{L}\p{M}'’\-]++(?:[ ]\p{Lu}[\p{L}\p{M}'’\-]++)*+",
}
PATTERN = r"(?<![\p{L}\p{N}])(?:" + "|".join(FORMS.values()) + ")"
_SECRET_KEY = r"^(?i:token|secret|password|passwd|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
_HEX = r"^(?:[0-9a-f]+|[0-9A-F]+)$"
ROUNDS = 40


def _full(form: str) -> str:
    return f"^(?:{form})$"


def matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def _kind(match: Column) -> Column:
    out = F.lit("other")
    for kind in reversed(FORMS):
        out = F.when(match.rlike(_full(FORMS[kind])), F.lit(kind)).otherwise(out)
    return out


def _script(word: Column) -> Column:
    """The script whose sounds a name gets; the letters of others are poured."""
    out = F.when(word.rlike(r"\p{IsLatin}"), F.lit("latin")).otherwise(F.lit("other"))
    for script in ("greek", "cyrillic"):
        out = F.when(word.rlike(rf"\p{{Is{script.title()}}}"), F.lit(script)).otherwise(out)
    return out


def _head_and_words(match: Column) -> tuple[Column, Column]:
    """The titles of a name (with the space after them) and its words."""
    head = F.regexp_extract(match, "^" + _TITLES, 0)
    return head, F.split(F.substr(match, F.length(head) + 1), " ")


def _entities(match: Column) -> Column:
    """Array of ``kind, canon`` of a match, one or, in a name, one for each word."""
    kind = _kind(match)
    digits = F.regexp_replace(match, r"\D", "")
    secret = F.regexp_replace(match, _SECRET_KEY, "")
    secret = F.when(secret.rlike(_HEX), F.lower(secret)).otherwise(secret)
    one = lambda k, c: F.array(F.struct(k.alias("kind"), c.alias("canon")))
    titles, words = _head_and_words(match)
    gender = F.lit("given_n")
    for given, listed in (("given_m", MALE_TITLES), ("given_f", FEMALE_TITLES)):
        gender = F.when(titles.rlike(rf"(?:^|[ ])(?:{'|'.join(listed)})\.?[ ]"), F.lit(given)).otherwise(gender)
    bare = F.transform(words, lambda w: F.regexp_replace(w, _ENDING, ""))
    names = F.transform(
        bare,
        lambda w, i: F.struct(
            F.concat(F.when(i == F.size(bare) - 1, F.lit("family")).otherwise(gender), F.lit(":"), _script(w)).alias("kind"), F.lower(w).alias("canon")
        ),
    )
    return (
        F.when(kind == "name", names)
        .when(kind == "email", one(kind, F.lower(match)))
        .when(kind.isin("secret", "hex"), one(F.lit("secret"), secret))
        .when(kind.isin("phone", "card", "ssn"), one(kind, digits))
        .when(kind == "iban", one(kind, F.regexp_replace(match, " ", "")))
        .otherwise(one(kind, match))
    )


def _number(hex_: Column, at: Column | int, width: int = 4) -> Column:
    """A number from ``width`` digits of the hash from the 0-based place on."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.substr(hex_, at + 1, F.lit(width)), 16, 10).cast("int")


def _pick(items: str | list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, items)), n % len(items) + 1)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas in ``body`` use it."""
    return F.transform(F.array(value), body)[0]


def _blocks(key: str, name: str, message: Column, digits: Column | int) -> Column:
    """An array of keyed hashes of the message, 64 hex digits each: ``digits`` in all, four hashes at least."""
    last = F.greatest(F.lit(3), F.floor((F.lit(digits) - 1) / 64).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.sha2(F.concat(F.lit(f"{key}:{name}"), k.cast("string"), F.lit(":"), message), 256))


def _poured(canon: Column, blocks: Column) -> Column:
    """Every digit and letter replaced by one of its own class and script; the rest stays."""

    def one(c: Column, i: Column) -> Column:
        at = F.floor(i * 3 / 64).cast("int")
        two = F.concat(F.get(blocks, at), F.coalesce(F.get(blocks, at + 1), F.lit("")))
        n = _number(two, (i * 3) % 64, 3)
        out = F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
        out = out.when(c.rlike("[a-z]"), _pick(list(LATIN), n)).when(c.rlike("[A-Z]"), _pick(list(LATIN.upper()), n))
        other = F.lit(None).cast("string")
        for script, letters in LETTERS.items():
            other = F.when(c.rlike(rf"\p{{Is{script}}}"), _pick(list(letters), n)).otherwise(other)
        return out.when(c.rlike(r"\p{L}"), F.coalesce(other, _pick(list(LATIN), n))).otherwise(c)

    return F.array_join(F.transform(F.split(canon, "(?!^)"), one), "")


def _drawn(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The surrogate of an entity at an attempt.  From the fifth on it is longer by digits
    where the form allows, so that short forms do not run out of surrogates."""
    message = F.concat_ws("|", kind, canon, attempt.cast("string"))
    inner = F.sha2(F.concat(F.lit(key + ":"), message), 256)
    blocks = _let(inner, lambda h: _blocks(key, "", h, F.length(canon) * 3))
    domain_blocks = _blocks(key, "domain", F.substring_index(canon, "@", -1), 256)
    return _let(blocks, lambda b: _let(domain_blocks, lambda d: _from_hash(kind, canon, attempt, b, d)))


def _from_hash(kind: Column, canon: Column, attempt: Column, blocks: Column, domain_blocks: Column) -> Column:
    hex_ = F.concat(*[blocks[k] for k in range(4)])
    n = lambda at: _number(hex_, at)
    extra = F.when(attempt > 4, F.lpad((n(200) % 10000).cast("string"), 4, "0")).otherwise(F.lit(""))
    pour = lambda c: _poured(c, blocks)
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    mail = F.concat(
        pour(local), extra, F.lit("@"), _poured(F.substring_index(domain, ".", 1), domain_blocks), F.lit(".example."),
        _pick(["com", "org", "net"], _number(domain_blocks[3], 48)),
    )
    ip = F.concat_ws(".", (n(0) % 15 + 240).cast("string"), *[(n(4 * k) % 256).cast("string") for k in (1, 2, 3)])
    ip = F.when(attempt > 8, F.concat_ws(".", (n(0) % 239 + 1).cast("string"), *[(n(4 * k) % 256).cast("string") for k in (1, 2, 3)])).otherwise(ip)
    secret = F.when(canon.rlike("^[0-9a-f]+$"), F.substr(F.array_join(blocks, ""), F.lit(1), F.length(canon))).otherwise(pour(canon))
    out = F.when(kind == "email", mail).when(kind == "ip", ip).when(kind == "secret", F.concat(secret, extra))
    out = out.when(kind.isin("phone", "card", "ssn", "iban"), F.concat(pour(canon), extra))
    for script, sounds in SOUNDS.items():
        for part, endings in ENDINGS[script].items():
            name = F.concat(_pick(sounds, n(0)), _pick(sounds, n(4)), F.when(attempt > 2, _pick(sounds, n(8))).otherwise(F.lit("")),
                            F.when(attempt > 6, _pick(sounds, n(12))).otherwise(F.lit("")), _pick(endings, n(16)))
            out = out.when(kind == f"{part}:{script}", name)
    return out.otherwise(pour(canon))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canon, surrogate`` for distinct entities ``kind, canon``, all surrogates of a kind distinct.

    Round by round, entities whose draw is taken (by an entity of an earlier
    round, or by a smaller one of this round) or is an entity itself draw
    again.  The driver sees one number a round.  Raises if a form runs out.
    """
    todo = entities
    real = entities.select("kind", F.col("canon").alias("surrogate"))
    done: DataFrame | None = None
    for attempt in range(ROUNDS):
        drawn = save(
            todo.select("kind", "canon", _drawn(key, F.col("kind"), F.col("canon"), F.lit(attempt)).alias("surrogate")), "pii-drawn"
        )
        taken = real if done is None else real.unionAll(done.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon")).join(taken, ["kind", "surrogate"], "left_anti")
        good = save(first.select("kind", "canon", "surrogate"), "pii-good")
        done = good if done is None else done.unionAll(good)
        if good.count() == drawn.count():
            return done
        todo = save(drawn.join(good, ["kind", "canon"], "left_anti").select("kind", "canon"), "pii-again")
    raise ValueError("the surrogates of some form ran out")


def _named(word: Column, surrogate: Column) -> Column:
    """A name's surrogate in the case of the word it stands for, with that word's ending."""
    bare = F.regexp_replace(word, _ENDING, "")
    shouted = (F.upper(bare) == bare) & (F.length(bare) > 1)
    return F.concat(F.when(shouted, F.upper(surrogate)).otherwise(F.initcap(surrogate)), F.regexp_extract(word, _ENDING, 0))


def _mentions(rest: Column, names: Column) -> Column:
    """``rest`` (what is between matches) with the document's own name words replaced; ``names`` maps them to surrogates."""

    def one(word: Column) -> Column:
        known = F.coalesce(names[F.lower(word)], names[F.lower(F.regexp_replace(word, _ENDING, ""))])
        # a word that is a name with its ending keeps it, one that is itself the name has none
        whole = names[F.lower(word)].isNotNull()
        new = F.when(whole & (F.upper(word) == word), F.upper(known)).when(whole, F.initcap(known)).otherwise(_named(word, known))
        return F.when(word.rlike(r"^\p{Lu}"), F.coalesce(new, word)).otherwise(word)

    return F.array_join(F.transform(F.regexp_extract_all(rest, F.lit(_TOKENS), F.lit(0)), one), "")


def _rendered(match: Column, parts: Column) -> Column:
    """The match with its surrogates in its own format."""
    kind, value = _kind(match), parts[0]
    copy_case = lambda s, like: F.when((F.upper(like) == like) & (F.lower(like) != like), F.upper(s)).otherwise(s)
    step = lambda z, c: F.when(
        c.rlike("[0-9A-Za-z]") & (z["k"] <= F.length(value)),
        F.struct(F.concat(z["out"], F.substr(value, z["k"], F.lit(1))).alias("out"), (z["k"] + 1).alias("k")),
    ).otherwise(F.struct(F.concat(z["out"], c).alias("out"), z["k"].alias("k")))
    poured = F.aggregate(
        F.split(match, "(?!^)"), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step,
        lambda z: F.concat(z["out"], F.substr(value, z["k"], F.length(value))),
    )
    head = F.regexp_extract(match, _SECRET_KEY, 0)
    bare = F.regexp_replace(match, _SECRET_KEY, "")
    title, words = _head_and_words(match)
    names = F.array_join(F.zip_with(words, parts, _named), " ")
    return (
        F.when(kind == "name", F.concat(title, names))
        .when(kind.isin("phone", "card", "ssn", "iban"), poured)
        .when(kind.isin("secret", "hex"), F.concat(head, F.when(bare.rlike(_HEX), copy_case(value, bare)).otherwise(value)))
        .when(kind == "email", copy_case(value, match))
        .otherwise(value)
    )


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit("key"), text).alias("_t2")]


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; other columns, also those with names used
    here, as they are; with ``count_col``, the number of matches in a column of that name.

    Null and empty texts and texts without a match stay as they are.  Whole
    texts are searched, of any length; where two forms fit at one place the one
    listed first names the kind; a word that is a given and a family name of its
    document gets the family's surrogate where it stands without a title.
    Repeated rows and equal texts get equal results; an empty table gives an
    empty result.  The same key gives the same draws for the same set of
    entities.  Mentions without a title do not count as matches.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    text = F.col("_row")[text_col].cast("string")
    scanned = docs.select(row).select("_row", F.coalesce(matches(text), F.array().cast("array<string>")).alias("_m"))
    scanned = save(scanned, "pii-scanned")
    hits = scanned.where(F.size("_m") > 0)
    found = save(hits.select(*_text_key(text), "_m").groupBy("_t1", "_t2").agg(F.first("_m").alias("_m")), "pii-matches")
    places = found.select("_t1", "_t2", F.posexplode("_m").alias("_pos", "_match"))
    parts = places.select("_t1", "_t2", "_pos", "_match", F.posexplode(_entities(F.col("_match"))).alias("_part", "_e")).select(
        "_t1", "_t2", "_pos", "_match", "_part", F.col("_e.kind").alias("kind"), F.col("_e.canon").alias("canon")
    )
    told = F.min(F.when(F.col("kind").rlike("^given_[fm]:"), F.col("kind"))).over(Window.partitionBy("_t1", "_t2", "canon"))
    parts = parts.withColumn("kind", F.when(F.col("kind").startswith("given_n:"), F.coalesce(told, "kind")).otherwise(F.col("kind")))
    parts = save(parts, "pii-parts")
    drawn = surrogates(save(parts.select("kind", "canon").distinct(), "pii-entities"), key)
    filled = save(parts.join(drawn, ["kind", "canon"]), "pii-filled")
    one = filled.groupBy("_t1", "_t2", "_pos").agg(
        F.first("_match").alias("_match"), F.sort_array(F.collect_list(F.struct("_part", "surrogate"))).alias("_s")
    )
    one = one.select("_t1", "_t2", F.struct("_pos", _rendered(F.col("_match"), F.col("_s.surrogate")).alias("_new")).alias("_new"))
    new = one.groupBy("_t1", "_t2").agg(F.sort_array(F.collect_list("_new")).alias("_new"))
    words = filled.where(F.col("kind").contains(":")).groupBy("_t1", "_t2", "canon").agg(F.min(F.struct("kind", "surrogate")).alias("_s"))
    words = words.groupBy("_t1", "_t2").agg(F.map_from_entries(F.collect_list(F.struct("canon", F.col("_s.surrogate")))).alias("_names"))
    new = save(new.join(words, ["_t1", "_t2"], "left").select("_t1", "_t2", F.col("_new._new").alias("_new"), "_names"), "pii-new")

    rest = F.split(text, PATTERN, -1)
    rest = F.when(F.col("_names").isNull(), rest).otherwise(F.transform(rest, lambda r: _mentions(r, F.col("_names"))))
    together = F.array_join(F.zip_with(rest, F.col("_new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = hits.select("_row", *_text_key(text)).join(new, ["_t1", "_t2"]).select("_row", together.alias("_text"), F.size("_new").alias("_n"))
    out = scanned.where(F.size("_m") == 0).select("_row", text.alias("_text"), F.lit(0).alias("_n")).unionAll(changed)
    columns = [F.col("_text").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    return out.select(*columns, *([F.col("_n").alias(count_col)] if count_col else []))
