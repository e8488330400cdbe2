"""Scalar text operators as columns; all run in generated code, none in Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataline.functions import lexicon as lx
from strataline.functions.patterns import any_java, java, needed

SPLIT = "\x01"


def words(c: Column) -> Column:
    """White-space separated words; an empty text has none."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.coalesce(F.size(words(c)), F.lit(0))


def last_word(c: Column) -> Column:
    return F.regexp_extract(c, r"(\S+)\s*$", 1)


def first_word(c: Column) -> Column:
    return F.regexp_extract(c, r"^\s*(\S+)", 1)


def heading_level(c: Column) -> Column:
    """-1 page numerals, 1 chapters and long capitals, 2 numbered sections, else 0."""
    t = F.trim(c)
    return (
        F.when((F.length(t) <= 4) & (t.rlike(r"^[0-9]+$") | t.rlike(r"^[IVXLC]+$")), -1)
        .when(t.rlike(r"(?i)^(Chapter|Part|Unit|Section|Appendix)\s+([0-9]+|[IVXLC]+)"), 1)
        .when((F.upper(t) == t) & (F.lower(t) != t) & (F.length(t) > 15), 1)
        .when(t.rlike(r"^[0-9]+\.[0-9]+\s"), 2)
        .otherwise(0)
    )


def ends_with_hyphen(c: Column) -> Column:
    """A word broken at the end: a hyphen after a prefix or a consonant, or hardly a word at all."""
    w = last_word(c)
    stem = F.lower(F.regexp_replace(w, "-+$", ""))
    broken = (F.length(w) <= 2) | stem.isin(*lx.COMPOUND_PREFIXES) | ((stem != "") & ~stem.rlike("[aeiou]$"))
    return F.coalesce(F.when(F.rtrim(c).endswith("-"), broken), F.lit(False))


def ends_with_open_clause(c: Column) -> Column:
    return F.coalesce(F.lower(last_word(F.regexp_replace(c, r"[.,;:!?]+\s*$", ""))).isin(*lx.OPEN_CLAUSE_WORDS), F.lit(False))


def has_fragment_pattern(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?:,|[=<>≤≥±]|\.\.\.|…)\s*$"), F.lit(False))


def starts_lowercase(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\p{Ll}"), F.lit(False))


def starts_like_continuation(c: Column) -> Column:
    first = F.lower(F.regexp_replace(first_word(c), "[.,;:]+$", ""))
    return F.coalesce(F.trim(c).rlike(r"^\p{Ll}") | first.isin(*lx.CONTINUATION_STARTERS), F.lit(False))


def has_terminal_mark(c: Column) -> Column:
    return F.coalesce(F.rtrim(c).rlike(r"[.?!:;]$"), F.lit(False))


def style_hints(c: Column, kind: Column) -> Column:
    """The 11 hints; null text counts as empty."""
    t = F.coalesce(c, F.lit(""))
    return F.struct(
        starts_lowercase(t).alias("starts_lowercase"), ((t != "") & ~has_terminal_mark(t)).alias("ends_incomplete"), (word_count(t) < 10).alias("is_short"),
        F.trim(t).rlike(r"^[0-9\-•●○▪]").alias("has_list_marker"), kind.alias("segment_type"), ends_with_hyphen(t).alias("ends_with_hyphen"),
        ends_with_open_clause(t).alias("ends_with_open_clause"), has_fragment_pattern(t).alias("has_fragment_pattern"),
        starts_like_continuation(t).alias("starts_like_continuation"), has_terminal_mark(t).alias("has_terminal_punctuation"), word_count(t).alias("word_count"),
    )


def small(c: Column) -> Column:
    """Small letters, with those that patterns take for a plain one in any case as that one."""
    rare = c.contains("ſ") | c.contains("İ") | c.contains("ı") | c.contains("\u212a")
    return F.lower(F.when(rare, F.translate(c, "ſİı\u212a", "siik")).otherwise(c))


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _matches(c: Column, low: Column, patterns: list[str], flags: str) -> Column:
    """Whether any pattern matches; the patterns are tried only on texts that hold a string that one of them needs."""
    needs = [needed(p) for p in patterns]
    hit = F.coalesce(c.rlike(any_java(patterns, flags)), F.lit(False))
    if any(n is None for n in needs):
        open_ones = [p for p, n in zip(patterns, needs) if n is None]
        rest = [p for p, n in zip(patterns, needs) if n is not None]
        if not rest:
            return hit
        return F.coalesce(c.rlike(any_java(open_ones, flags)), F.lit(False)) | _matches(c, low, rest, flags)
    has = None
    for x in sorted(frozenset().union(*needs)):
        has = low.contains(x) if has is None else has | low.contains(x)
    return F.when(has, hit).otherwise(F.lit(False))


def matches(c: Column, patterns: list[str], flags: str = "iud") -> Column:
    return F.coalesce(bound(small(c), lambda low: _matches(c, low, patterns, flags)), F.lit(False))


def tags(c: Column, rules: dict[str, list[str]] | None = None, lines: bool = True) -> Column:
    """Tags of a text in the order of the rules; one alternation for each tag."""
    rules = rules or lx.TAGS
    flags = "iumd" if lines else "iud"
    every = lambda low: F.array(*[F.when(_matches(c, low, p, flags), F.lit(t)) for t, p in rules.items()])
    return F.array_compact(bound(small(c), every))


def is_imperative(c: Column, verbs: list[str] | None = None) -> Column:
    return F.coalesce(F.lower(F.regexp_replace(first_word(c), "[.,;:]+$", "")).isin(*(verbs or lx.IMPERATIVE_VERBS)), F.lit(False))


def sentences(c: Column) -> Column:
    """Sentences after stops and white space; blank ones are left out."""
    return F.filter(F.transform(F.split(F.regexp_replace(F.trim(c), r"([.!?])\s+", "$1" + SPLIT), SPLIT), lambda s: F.trim(s)), lambda s: s != "")


def last_sentences(c: Column, n: int = 2) -> Column:
    s = sentences(c)
    return F.when(F.size(s) <= n, c).otherwise(F.array_join(F.slice(s, -n, n), " "))


def sentence_form(c: Column, imperative: Column) -> Column:
    t = F.trim(c)
    return (
        F.when(t.endswith("?"), "interrogative").when(imperative, "imperative")
        .when(c.rlike(r"[=+\-*/^]{2,}") | c.rlike(java(r"\w+\s*=\s*\w+")), "formula").when(F.length(t) < 10, "fragment").otherwise("declarative")
    )


def heading_hint(path: Column) -> Column:
    """The role of the first keyword, in list order, that the path contains; null if none."""
    low = F.lower(path)
    return F.coalesce(*[F.when(low.contains(k), F.lit(r)) for k, r in lx.HEADING_ROLES.items()])


def role(c: Column, path: Column, found: Column, form: Column, imperative: Column, kind: Column, entities: Column | None = None) -> Column:
    """The role of a sentence by the cascade of rules; ``entities`` (named ones found) is a plug-in column."""
    t, low = F.trim(c), F.lower(c)
    entities = F.lit(False) if entities is None else entities
    short = (F.length(t) < 15) & ~(entities & (word_count(t) > 1)) & ~matches(c, lx.SHORT_EXCEPTIONS)
    out = (
        F.when(matches(c, [r"^(?:For example|For instance|e\.g\.|eg\.?)\b"]), "example")
        .when(matches(c, [r"^(?:In summary|Therefore|Thus|To summarize|Consequently)\b"]), "conclusion")
        .when(form == "interrogative", "question")
        .when(F.array_contains(found, "reference"), "reference")
        .when(short | matches(low, lx.BOILERPLATE), "irrelevant")
    )
    p = F.coalesce(path, F.lit(""))
    starts = c.rlike(java(r"^\s*(?:Suppose|Assume|Imagine)\b"))
    case = kind.isin("exercise", "question", "example") | p.rlike("(?i)exercise|problem|case")
    allow = {
        "mechanism": ~p.rlike(r"(?i)front\s*matter") & ~low.rlike(java(r"\b(?:chapter|author|text|preface|acknowledgment)\b")) & kind.isin("explanation", "example", "paragraph"),
        "assumption": starts | case | (word_count(t) <= 40),
        "procedure": imperative | low.rlike(java(r"^(?:first|second|next|then|finally)\b")),
    }
    for r in lx.ROLE_PRIORITY:
        has = F.array_contains(found, r)
        out = out.when(has & F.coalesce(allow[r], F.lit(False)) if r in allow else has, r)
    return out.otherwise(F.coalesce(heading_hint(path), F.lit("explanation")))


def role_by_keywords(c: Column) -> Column:
    """The role of a sentence in the embedding profile."""
    low = F.lower(c)
    out = F.when(c.contains("?"), "question").when(low.contains("for example") | low.contains("e.g.") | low.rlike(r"^example\s+[0-9]+"), "example")
    for r, keys in lx.EMBEDDING_ROLES:
        out = out.when(low.rlike("|".join(keys)), r)
    return out.when(low.rlike("%|table|figure|exhibit") & (F.length(c) > 20), "evidence").otherwise("explanation")


def is_objective(c: Column) -> Column:
    """Whether a text reads like a learning objective."""
    low = F.lower(F.trim(c))
    verb = F.element_at(F.filter(F.split(low, r"\s+"), lambda w: w != ""), 1).isin(*lx.OBJECTIVE_VERBS) & (word_count(low) > 3)
    return F.coalesce((F.length(F.trim(c)) >= 5) & (low.rlike(any_java(lx.OBJECTIVE_PATTERNS)) | F.when(word_count(low) > 0, verb).otherwise(False)), F.lit(False))


def plain_title(c: Column) -> Column:
    """A title without anything but small letters and digits."""
    return F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]", "")


def furniture_form(c: Column) -> Column:
    """A line without page numbers, squeezed and in small letters."""
    low = F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    return F.trim(F.regexp_replace(low, java(r"\b(?:page\s*)?[0-9]+\b"), ""))


def is_trivial(c: Column) -> Column:
    return c.rlike(r"^[0-9\s.,-]+$") | (F.length(c) <= 2) | c.rlike("^[ivxlcdmIVXLCDM]+$")


def plausible_word(c: Column) -> Column:
    """Letters with runs of at most 5 consonants and 4 vowels; hyphens are passed over."""
    t = F.regexp_replace(c, "-", "")
    return t.rlike(r"^\p{L}+$") & ~t.rlike("(?i)[^aeiou]{6,}") & ~t.rlike("(?i)[aeiou]{5,}")


def spaced_text(c: Column) -> Column:
    """Letters set apart by single spaces are joined; three spaces part words."""
    ws = words(c)
    single = F.size(F.filter(ws, lambda w: F.length(w) == 1)) / F.size(ws)
    parts = F.split(c, r"\s{3,}")
    joined = F.when(F.size(parts) > 1, F.array_join(F.transform(parts, lambda p: F.regexp_replace(p, r"\s+", "")), " ")).otherwise(F.array_join(ws, ""))
    spaced = (F.length(c) >= 5) & c.rlike(r"[A-Za-z]\s[A-Za-z]\s[A-Za-z]") & (F.size(ws) >= 3) & (single > 0.6)
    return F.when(spaced, joined).otherwise(c)


def isbn(c: Column) -> Column:
    """The ISBN that a text states, without separators; null if none."""
    one = F.regexp_extract(c, r"(?i)ISBN(?:-13|-10)?[:\s]+(?:\d{1,5}[-\s]?)?(\d+[-\s]?\d+[-\s]?\d+[-\s]?\d+[-\s]?\d+)", 1)
    two = F.regexp_extract(c, r"(?i)ISBN\s+([0-9-]{10,25})", 1)
    found = F.when(one != "", one).when(two != "", two)
    return F.regexp_replace(found, "[- ]", "")


def caption(c: Column) -> Column:
    """(caption_id, target_type, full_caption_id) of a caption; null for other texts, among them sentences about a block."""
    t = F.trim(c)
    low = F.lower(t)
    kind = (
        F.when(low.rlike("^(?:table|tbl)"), "Table").when(low.rlike("^(?:figure|fig|chart|graph|diagram)"), "Figure")
        .when(low.startswith("exhibit"), "Exhibit").when(low.rlike("^(?:equation|eq|formula)"), "Equation").otherwise("Figure")
    )
    verbs = java(r"\b(?:" + "|".join(lx.CAPTION_VERBS) + r")\b")
    number = []
    for p in lx.CAPTION_PATTERNS:
        found = F.regexp_extract(t, "(?i)" + p, 1)
        after = F.substring(F.lower(F.trim(F.regexp_replace(t, "(?i)" + p, ""))), 1, 100)
        number.append(F.when((found != "") & ~after.rlike(verbs), found))
    n = F.coalesce(*number)
    return F.when(n.isNotNull() & (word_count(t) <= 40), F.struct(n.alias("caption_id"), kind.alias("target_type"), F.concat_ws(" ", kind, n).alias("full_caption_id")))


def block_id(c: Column, kind: Column) -> Column:
    """The key of a block in the catalog: of its own kind, or for text the first kind that fits."""
    t = F.trim(c)
    each = {k: F.regexp_extract(t, "(?i)" + p, 1) for k, p in lx.CATALOG_PATTERNS}
    name = lambda k: F.when(each[k] != "", F.concat(F.lit(("Figure" if k == "Picture" else k) + " "), each[k]))
    out = F.when(kind.isin("Header", "Title", "Paragraph", "Text"), F.coalesce(*[name(k) for k in each]))
    for k in each:
        out = out.when(kind == k, name(k))
    return out


def near_block(a: Column, b: Column, height: float, distance: float, overlap: float) -> Column:
    """Whether a caption's and a block's boxes are close; true where one has none."""
    gap = F.when(a[3] <= b[1], b[1] - a[3]).when(b[3] <= a[1], a[1] - b[3]).otherwise(F.lit(0.0))
    scale = F.when(F.greatest(F.array_max(a), F.array_max(b)) > 1.0, F.lit(height)).otherwise(F.lit(1.0))
    shared = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    narrow = F.least(a[2] - a[0], b[2] - b[0])
    ok = (gap / scale <= distance) & (shared > 0) & (F.when(narrow > 0, shared / narrow).otherwise(0.0) >= overlap)
    return F.when(a.isNull() | b.isNull() | (F.size(a) < 4) | (F.size(b) < 4), True).otherwise(ok)


def context_text(path: Column, tag_list: Column, c: Column) -> Column:
    """[Path: ...] [Tags: ...] text, without the parts that are empty."""
    return F.concat_ws(" ", F.when(path != "", F.concat(F.lit("[Path: "), path, F.lit("]"))), F.when(F.size(tag_list) > 0, F.concat(F.lit("[Tags: "), F.array_join(tag_list, ", "), F.lit("]"))), c)


def segment_type(label: Column, kind: Column, path: Column) -> Column:
    """The type of a parsed item from its label, the name of its class and its heading path."""
    lab, name = F.lower(F.coalesce(label, F.lit(""))), F.lower(F.coalesce(kind, F.lit("")))
    objective = F.upper(F.coalesce(path, F.lit(""))).rlike("OBJECTIVES|LEARNING OBJECTIVE") & name.contains("list")
    return (
        F.when(objective, "LearningObjective").when(lab.rlike("|".join(lx.HEADING_LABELS)) & ~lab.rlike("|".join(lx.NOISE_LABELS)), "Header").when(lab.contains("caption"), "Caption")
        .when(name.contains("table"), "Table").when(name.contains("list"), "ListItem").when(name.rlike("formula|equation"), "Formula").when(name.rlike("picture|image"), "Picture").otherwise("Paragraph")
    )


def is_structural_header(c: Column, kind: Column) -> Column:
    """Whether a text is a heading of the structure: no caption, and worded or typed as a heading."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return (t != "") & caption(t).isNull() & (matches(t, lx.STRUCTURAL_HEADERS) | F.coalesce(kind == "Header", F.lit(False)))


def question_target(c: Column, role_of: Column, found: Column) -> Column:
    """What a question refers to (its first figure, table ...); null for other sentences."""
    target = F.regexp_extract(c, r"(?i)((?:figure|fig\.?|table|exhibit|equation|eq\.?)\s+[0-9.]+)", 1)
    return F.when((role_of == "question") & F.array_contains(found, "reference"), target)


def role_legacy(c: Column, path: Column, found: Column, form: Column, imperative: Column, kind: Column) -> Column:
    """The older cascade: no overrides, entities or rules for assumptions. ``found``: tags by ``TAGS_LEGACY``."""
    low = F.lower(c)
    short = (F.length(F.trim(c)) < 15) & ~matches(c, lx.SHORT_EXCEPTIONS)
    allow = {
        "mechanism": ~F.coalesce(path, F.lit("")).rlike(r"(?i)front\s*matter") & ~c.rlike(java(r"\bNote:|\bMcGraw\s*Hill\b")) & kind.isin("explanation", "example", "paragraph"),
        "procedure": imperative | low.rlike(java(r"^(?:first|second|next|then|finally)\b")),
    }
    out = F.when(form == "interrogative", "question").when(F.array_contains(found, "reference"), "reference").when(short | matches(low, lx.BOILERPLATE), "irrelevant")
    for r in lx.ROLE_PRIORITY:
        has = F.array_contains(found, r)
        out = out.when(has & F.coalesce(allow[r], F.lit(False)) if r in allow else has, r)
    return out.otherwise(F.coalesce(heading_hint(path), F.lit("explanation")))


def role_by_stages(c: Column, path: Column, imperative: Column, last: Column | None = None) -> Column:
    """The older embedding profile's role, without the sentence before: stages in order, then filters by context, then
    the heading. ``last`` marks a chunk's last sentence, where closing words conclude."""
    low, t = F.lower(c), F.trim(c)
    last = F.lit(False) if last is None else last
    hit = {r: (matches(low, a, "ud") if a else F.lit(False)) | (matches(c, b, "ud") if b else F.lit(False)) for r, a, b in lx.ROLE_STAGES}
    hit["evidence"] = matches(c, lx.EVIDENCE)
    hit["conclusion"] = hit["conclusion"] | (last & matches(low, [r"\b(overall|ultimately|finally)\b"], "ud"))
    does = low.rlike(java(r"\b(calculate|compute|determine|solve|find|use|apply|enter|click|select)\b"))
    hit["procedure"] = hit["procedure"] | (imperative & (word_count(t) >= 8) & does)
    stage = F.when(c.rlike("|".join(f"(?:{p})" for p in lx.STAGE_REFERENCES)), "reference").when((F.length(t) < 10) & ~matches(c, lx.SHORT_EXCEPTIONS), "irrelevant")
    for r, _, _ in lx.ROLE_STAGES:
        stage = stage.when(hit[r], F.when(hit["formula"], "formula").otherwise("evidence") if r == "evidence" else F.lit(r))

    def judged(stage: Column) -> Column:
        barred = F.lit(False)
        for r, p in lx.NOT_IN_CONTEXT.items():
            barred = barred | ((stage == r) & matches(low, p, "ud"))
        final = F.when(t.endswith("?"), "question").when(matches(low, lx.STAGE_BOILERPLATE, "ud"), "irrelevant").when(barred, "explanation").otherwise(stage)
        return bound(final, lambda f: F.when(f == "explanation", F.coalesce(heading_hint(path), f)).otherwise(f))

    return bound(stage.otherwise("explanation"), judged)


def caption_legacy(c: Column, kind: Column | None = None) -> Column:
    """(caption_id, target_type) by the older rules: of any length; a verb right after the number makes a sentence of it.
    With ``kind`` a text typed as a caption is one whatever it says ("unknown" where no number of a table begins it)."""
    t = F.trim(F.coalesce(c, F.lit("")))
    low = F.lower(t)
    target = (
        F.when(low.rlike("^(?:table|tbl)"), "Table").when(low.rlike("^(?:figure|fig|chart|graph|diagram)"), "Figure")
        .when(low.startswith("exhibit"), "Exhibit").when(low.rlike("^(?:equation|eq|formula)"), "Equation").otherwise("Figure")
    )
    verbs = "^(?:" + "|".join(lx.CAPTION_VERBS_LEGACY) + ")"
    found = [(F.regexp_extract(t, "(?i)" + p, 1), F.lower(F.trim(F.regexp_replace(t, "(?i)" + p, "")))) for p in lx.CAPTION_PATTERNS]
    number = F.coalesce(*[F.when((n != "") & ~after.rlike(verbs), n) for n, after in found])
    if kind is not None:
        number = F.when(F.coalesce(kind == "Caption", F.lit(False)) & (t != ""), F.when(found[0][0] != "", found[0][0]).otherwise("unknown")).otherwise(number)
    return F.when(number.isNotNull(), F.struct(number.alias("caption_id"), target.alias("target_type")))


def caption_by_prefix(c: Column) -> Column:
    """The target type of a caption by the embedding profile's two prefixes; null for other texts."""
    t = F.trim(F.coalesce(c, F.lit("")))
    low = F.lower(t)
    target = F.when(low.contains("table"), "Table").when(low.rlike(r"figure|fig\.|chart|graph|exhibit"), "Figure").when(low.rlike("equation|formula"), "Equation").otherwise("Block")
    return F.when(matches(t, lx.CAPTION_PREFIXES), target)


def fallback_hints(c: Column) -> Column:
    """The seven hints of a text that came without any; a hyphen is one whatever stands before it."""
    t = F.coalesce(c, F.lit(""))
    end = F.regexp_replace(t, r"\s+$", "")
    lower_start = F.regexp_replace(t, r"^\s+", "").rlike(r"^\p{Ll}")
    first = F.lower(F.regexp_replace(first_word(t), "[.,;:]+$", ""))
    stop = end.rlike(r"[.?!:;]$")
    return F.struct(
        lower_start.alias("starts_lowercase"), ((t != "") & ~stop).alias("ends_incomplete"), F.lower(last_word(F.regexp_replace(end, "[.,;:!?]+$", ""))).isin(*lx.OPEN_CLAUSE_WORDS).alias("ends_with_open_clause"),
        (lower_start | first.isin(*lx.CONTINUATION_STARTERS)).alias("starts_like_continuation"), stop.alias("has_terminal_punctuation"), end.endswith("-").alias("ends_with_hyphen"), (end.endswith(",") | end.endswith("...")).alias("has_fragment_pattern"),
    )


def forced_role(kind: Column, all_furniture: Column) -> Column:
    """The role that a chunk gives all its sentences: a heading's are topics, those of furniture alone irrelevant; else null."""
    return F.when(kind == "header", "topic").when(F.coalesce(all_furniture, F.lit(False)), "irrelevant")
