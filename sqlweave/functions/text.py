"""Column-level helpers on statement text. All are built-in Spark expressions (JVM-side,
whole-stage codegen); Java regex syntax, so the back-reference of L5 works as written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour; kept together, in natural order).
# Statement prefixes dropped by the script loader (upper-cased text, with the blank):
NOISE_PREFIXES = ("SET ", "ALTER ", "USE ", "MSCK ", "ADD ", "USING ", "DROP ")
# ... and the suffix that marks a jar reference:
NOISE_SUFFIX = ".JAR'"
# Line comment as the loader removes it (Java regex, '.' stops at line ends):
LINE_COMMENT = "--.*"
# Blank-line collapse of the loader: ((\r\n)|\n)[\s\t ]*(\1)+  ->  $1
BLANK_LINES = "((\\r\\n)|\\n)[\\s\\t ]*(\\1)+"
# CTAS prefix of the Flink path, matched on the lower-cased normalised text:
CTAS_PREFIX = "^(create table ([\\w.]+) as )([\\s\\S]+)$"
# ---------------------------------------------------------------------------------------

# Literal / comment mask (L9). Possessive runs keep Java's regex engine from recursing per
# character on long literals.
# Block comments nest (to this depth; beyond it, and where one never closes, a comment ends at
# the first closing mark).
COMMENT_DEPTH = 4


def _comment(depth: int) -> str:
    inner = f"|{_comment(depth - 1)}" if depth > 1 else ""
    return f"/\\*(?:[^*/]++|\\*(?!/)|/(?!\\*){inner})*+\\*/"


_COMMENT = f"{_comment(COMMENT_DEPTH)}|/\\*(?s:.*?)\\*/"
MASK = ("'(?:[^'\\\\]++|\\\\.|'')*+'"
        "|\"(?:[^\"\\\\]++|\\\\.)*+\""
        f"|{_COMMENT}"
        "|--[^\\r\\n]*")
# ANSI quoting (Calcite's default): double quotes delimit identifiers, not strings, so
# they are not masked.
MASK_ANSI = ("'(?:[^'\\\\]++|\\\\.|'')*+'"
             f"|{_COMMENT}"
             "|--[^\\r\\n]*")
# Lexing of a statement: what is quoted stays whole while comments become blanks, then literals become marks.
_LITERAL = "'(?:[^'\\\\]++|\\\\(?s:.)|'')*+'|\"(?:[^\"\\\\]++|\\\\(?s:.))*+\""
_LITERAL_ANSI = "'(?:[^'\\\\]++|\\\\(?s:.)|'')*+'"
_QUOTED_NAME = "`[^`]*+`"
_QUOTED_NAME_ANSI = "`[^`]*+`|\"[^\"]*+\""
_FLAT_COMMENT = "/\\*(?:[^*]++|\\*(?!/))*+\\*/|--[^\\r\\n]*"
# an opening comment mark and a second one before any closing mark
_NESTED = "/\\*(?:[^*/]++|\\*(?!/)|/(?!\\*))*+/\\*"
# the pieces that can change a lexer's state, and the runs between them
_LEXEME = "--|/\\*|\\*/|\\\\['\"\\\\]|['\"`\\r\\n]|[^-'\"`\\\\/*\\r\\n]++|(?s:.)"
_HELD = "\u0001"
_NAME = "(?:`[^`]+`|[\\p{L}\\p{N}_$]+)"
_NAME_ANSI = "(?:`[^`]+`|\"[^\"]+\"|[\\p{L}\\p{N}_$]+)"
# Token pattern (L10): dotted name, bracket/comma/semicolon/mask mark, operator run.
TOKEN = f"{_NAME}(?:\\.{_NAME})*|[(),;?]|[-+*/%=<>!|&^~]+"
TOKEN_ANSI = f"{_NAME_ANSI}(?:\\.{_NAME_ANSI})*|[(),;?]|[-+*/%=<>!|&^~]+"
# Java String.trim(): every char <= U+0020 at both ends.
_JAVA_TRIM = "".join(map(chr, range(0x21)))


def java_trim(c: Column) -> Column:
    return F.trim(c, F.lit(_JAVA_TRIM))


def strip_comments(c: Column) -> Column:
    """L3: trim, drop '--' comments to end of line, trim again (Java trim). Only texts with a comment mark meet the regex."""
    t = java_trim(c)
    return F.when(t.contains("--"), java_trim(F.regexp_replace(t, LINE_COMMENT, ""))).otherwise(t)


def is_noise(c: Column) -> Column:
    """L4: empty text or a SET/ALTER/USE/MSCK/ADD/USING/DROP statement or a jar reference."""
    # Only the ends are upper-cased, and the text is computed once: Spark moves this condition below the projection that cuts and
    # cleans the text, and would put that work in for each use of it. An upper-cased text has no fewer characters than the text.
    def ends(x: Column) -> Column:
        return F.struct((x == "").alias("empty"), F.upper(F.substring(x, 1, max(map(len, NOISE_PREFIXES)))).alias("head"),
                        F.upper(F.substring(x, -len(NOISE_SUFFIX), len(NOISE_SUFFIX))).alias("tail"))

    def noise(e: Column) -> Column:
        starts = None
        for p in NOISE_PREFIXES:
            s = e["head"].startswith(p)
            starts = s if starts is None else (starts | s)
        return e["empty"] | starts | e["tail"].endswith(NOISE_SUFFIX)
    return _out_of_line(_out_of_line(c, ends), noise)


def collapse_blank_lines(c: Column) -> Column:
    """A line break followed by blank lines becomes one line break."""
    return F.when(c.contains("\n"), F.regexp_replace(c, BLANK_LINES, "$1")).otherwise(c)


def cut_semicolon(c: Column) -> Column:
    """L7 (departure D5): cut a trailing semicolon and the blanks after it."""
    return F.regexp_replace(c, ";[\\x00-\\x20]*$", "")


def _replace_unheld(c: Column, held: str, gone: str, mark: str) -> Column:
    """Every ``gone`` outside of ``held`` text becomes ``mark``. Java's replacement text can't depend on the alternative that matched:
    a control character goes behind both, is taken off again behind held text, and what is left of it becomes the mark."""
    c = F.regexp_replace(c, f"({held})|{gone}", f"$1{_HELD}")
    return F.regexp_replace(F.regexp_replace(c, f"({held}){_HELD}", "$1"), _HELD, mark)


def _without_nested_comments(c: Column, held: str) -> Column:
    """Comments as blanks by one pass over the pieces, at any depth: modes 0 text, 1 to 3 inside quotes (single, double, back), 4 line
    comment, 4 + d block comment of depth d. From a block comment that never closes on (``at``), comments end at their first closing mark."""
    def step(state: Column, piece: Column) -> Column:
        m = state["mode"]
        opened = (F.when(piece == "'", 1).when(piece == '"', 2).when(piece == "`", 3).when(piece == "--", 4).when(piece == "/*", 5).otherwise(0))
        closes = ((m == 1) & (piece == "'")) | ((m == 2) & (piece == '"')) | ((m == 3) & (piece == "`")) | ((m == 4) & piece.isin("\r", "\n"))
        depth = F.when(piece == "/*", m + 1).when(piece == "*/", F.when(m == 5, 0).otherwise(m - 1)).otherwise(m)
        now = F.when(m == 0, opened).when(m >= 5, depth).when(closes, 0).otherwise(m)
        kept = F.when((m == 0) & (now >= 4), " ").when((m >= 5) | ((m == 4) & (now == 4)), "").otherwise(piece)
        at = F.when((m == 0) & (now == 5), state["read"]).otherwise(state["at"])
        return F.struct(F.concat(state["out"], kept).alias("out"), now.alias("mode"), (state["read"] + F.length(piece)).alias("read"), at.alias("at"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("mode"), F.lit(0).alias("read"), F.lit(0).alias("at"))

    def finish(end: Column) -> Column:
        rest = _replace_unheld(F.substr(c, end["at"] + 1), held, _FLAT_COMMENT, " ")
        return F.when(end["mode"] >= 5, F.concat(end["out"], rest)).otherwise(end["out"])
    # arrays of one text, or of none: Spark computes the body of a lambda for each element alone, and never ahead of the condition
    texts = F.when(c.contains("/*") & c.rlike(_NESTED), F.array(c)).otherwise(F.array().cast("array<string>"))
    ends = F.transform(texts, lambda x: F.aggregate(F.regexp_extract_all(x, F.lit(_LEXEME), 0), start, step))
    return F.get(F.transform(ends, finish), F.lit(0))


def blank_comments(c: Column, quotes: str = "hive") -> Column:
    """Both comment kinds become a blank; block comments nest to any depth. Comment marks in quoted text stay. Texts without
    comment marks, most of them, pass through; only nested ones take the piecewise pass."""
    held = f"{_LITERAL_ANSI}|{_QUOTED_NAME_ANSI}" if quotes == "ansi" else f"{_LITERAL}|{_QUOTED_NAME}"
    return (F.when(~(c.contains("--") | c.contains("/*")), c).when(c.rlike(_NESTED), _without_nested_comments(c, held))
            .otherwise(_replace_unheld(c, held, _FLAT_COMMENT, " ")))


def _out_of_line(c: Column, f) -> Column:
    """f(c) as the body of a lambda over one element. Spark generates no code for such a body: a long chain of conditions would make
    the generated method of the whole stage, with its loop over tokens, too long for the JVM to compile."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def mask_literals(c: Column, quotes: str = "hive") -> Column:
    """Comments become a blank, string literals ' ? '. With ``quotes='ansi'`` double-quoted text is an identifier and stays.
    A comment leaves no mark, so what the rules see next to a word doesn't depend on comments."""
    held, literal = (_QUOTED_NAME_ANSI, _LITERAL_ANSI) if quotes == "ansi" else (_QUOTED_NAME, _LITERAL)

    def masked(text: Column) -> Column:
        # quotes inside quoted names open no literal
        return (F.when(~(text.contains("'") | text.contains('"')), text)
                .when(text.contains("`") | F.lit(quotes == "ansi"), _replace_unheld(text, held, literal, " ? "))
                .otherwise(F.regexp_replace(text, literal, " ? ")))
    return _out_of_line(_out_of_line(c, lambda x: blank_comments(x, quotes)), masked)


def normalise_sql(c: Column) -> Column:
    """Blanks around commas, whitespace squeezed, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, ",", " , "), "\\s+", " "))


def ctas_target(c: Column) -> Column:
    """Target of a leading 'create table <name> as ' (lower-cased), else null."""
    t = F.regexp_extract(F.lower(c), CTAS_PREFIX, 2)
    return F.when(t != "", t)


def strip_ctas(c: Column) -> Column:
    """Cut the 'create table <name> as ' prefix, if there is one, from normalised text."""
    prefix = F.regexp_extract(F.lower(c), CTAS_PREFIX, 1)
    return F.when(prefix != "", F.substr(c, F.length(prefix) + 1)).otherwise(c)


def query_hash(c: Column) -> Column:
    """md5 of the query text (hex)."""
    return F.md5(c)


# ---------------------------------------------------------------------------------------
# Statement kinds (L25). Applied to masked, comment-free, trimmed, lower-cased text.
_N = "((?:`[^`]+`|\"[^\"]+\"|[\\p{L}\\p{N}_$]+)(?:\\.(?:`[^`]+`|\"[^\"]+\"|[\\p{L}\\p{N}_$]+))*)"
KIND_RULES = [
    # kind, pattern, group of the object name or 0, role of the object
    ("explain", "^explain\\b", 0, None),
    ("insert_directory", "^insert\\s+overwrite\\s+(?:local\\s+)?directory\\b", 0, None),
    ("insert", "^(insert\\b|from\\b.*\\binsert\\s+(into|overwrite)\\b|with\\b.*\\binsert\\s+(into|overwrite)\\b)", 0, None),
    ("create_table_like", f"^create\\s+(?:temp(?:orary)?\\s+)?(?:external\\s+)?table\\s+(?:if\\s+not\\s+exists\\s+)?{_N}\\s+like\\s+{_N}", 1, "like"),
    ("ctas", f"^create\\s+(?:temp(?:orary)?\\s+)?(?:external\\s+)?table\\s+(?:if\\s+not\\s+exists\\s+)?{_N}\\b.*\\bas\\s*\\(?\\s*(select|with|from)\\b", 1, None),
    ("create_table", f"^create\\s+(?:temp(?:orary)?\\s+)?(?:external\\s+)?table\\s+(?:if\\s+not\\s+exists\\s+)?{_N}", 1, None),
    ("create_view", f"^create\\s+(?:or\\s+replace\\s+)?(?:global\\s+)?(?:temp(?:orary)?\\s+)?view\\s+(?:if\\s+not\\s+exists\\s+)?{_N}", 1, None),
    ("alter_view_as", f"^alter\\s+view\\s+{_N}\\s+as\\b", 1, "out"),
    ("add_partition", f"^alter\\s+table\\s+{_N}\\s+add\\s+(?:if\\s+not\\s+exists\\s+)?partition\\b", 1, "out"),
    ("drop_partition", f"^alter\\s+table\\s+{_N}\\s+drop\\s+(?:if\\s+exists\\s+)?partition\\b", 1, "out"),
    ("add_columns", f"^alter\\s+table\\s+{_N}\\s+add\\s+columns\\b", 1, "out"),
    ("recover_partitions", f"^(?:alter\\s+table\\s+{_N}\\s+recover\\s+partitions|msck\\s+repair\\s+table\\s+{_N})", -1, "out"),
    ("rename_table", f"^alter\\s+(?:table|view)\\s+{_N}\\s+rename\\s+to\\s+{_N}", 1, "rename"),
    ("set_properties", f"^alter\\s+(?:table|view)\\s+{_N}\\s+(?:un)?set\\s+tblproperties\\b", 1, "out"),
    ("alter_table", f"^alter\\s+table\\s+{_N}", 1, "out"),
    ("alter_view", f"^alter\\s+view\\s+{_N}", 1, "out"),
    ("drop_view", f"^drop\\s+view\\s+(?:if\\s+exists\\s+)?{_N}", 1, "out"),
    ("describe_query", "^desc(?:ribe)?\\s+(?:query\\s+)?(?:select|with|from|values|table\\s+\\S+\\s+(?:union|where))\\b", 0, None),
    ("describe", "^desc(?:ribe)?\\s+(?:function|database|schema|catalog|namespace|procedure)\\b", 0, None),
    ("describe_table", f"^desc(?:ribe)?\\s+(?:table\\s+)?(?:(?:extended|formatted)\\s+)?{_N}", 1, "in"),
    ("refresh", "^refresh\\s+(?:function\\b|[^\\p{L}`\"_])", 0, None),
    ("refresh_table", f"^refresh\\s+(?:table\\s+)?{_N}", 1, "in"),
    ("uncache_table", f"^uncache\\s+table\\s+(?:if\\s+exists\\s+)?{_N}", 1, "in"),
    ("comment_on_table", f"^comment\\s+on\\s+(?:table|view)\\s+{_N}\\s+is\\b", 1, "out"),
    ("drop_table", f"^drop\\s+table\\s+(?:if\\s+exists\\s+)?{_N}", 1, "out"),
    ("show_create_table", f"^show\\s+create\\s+table\\s+{_N}", 1, "in"),
    ("create_database", f"^create\\s+(?:database|schema)\\s+(?:if\\s+not\\s+exists\\s+)?{_N}", 1, "in"),
    ("drop_database", f"^drop\\s+(?:database|schema)\\s+(?:if\\s+exists\\s+)?{_N}", 1, "in"),
    ("alter_database", f"^alter\\s+(?:database|schema)\\s+{_N}\\s+set\\s+(?:db)?properties\\b", 1, "in"),
    ("replace_table_as", f"^(?:create\\s+or\\s+)?replace\\s+table\\s+{_N}\\b.*\\bas\\s*\\(?\\s*(?:select|with|from|table|values)\\b", 1, "out"),
    ("cache_table_as", f"^cache\\s+(?:lazy\\s+)?table\\s+{_N}\\b.*\\b(?:select|with|from|values)\\b", 1, "out"),
    ("cache_table", f"^cache\\s+(?:lazy\\s+)?table\\s+{_N}", 1, "in"),
    ("load_data", f"^load\\s+data\\b.*\\binto\\s+table\\s+{_N}", 1, "out"),
    ("analyze_table", f"^analyze\\s+table\\s+{_N}", 1, "out"),
    ("truncate_table", f"^truncate\\s+table\\s+{_N}", 1, "out"),
    ("merge", f"^merge\\s+into\\s+{_N}(?:(?:\\s+as)?\\s+(?!using\\b){_N})?\\s+using\\s+(?:{_N}|\\()", 1, "merge"),
    ("update", f"^update\\s+{_N}", 1, "out"),
    ("delete", f"^delete\\s+from\\s+{_N}", 1, "out"),
    ("show", "^show\\b", 0, None),
    ("use", "^use\\b", 0, None),
    ("set", "^(?:re)?set\\b", 0, None),
    ("add_jar", "^add\\s+jars?\\b", 0, None),
    ("create_function", "^create\\s+(?:or\\s+replace\\s+)?(?:temporary\\s+)?function\\b", 0, None),
    ("drop_function", "^drop\\s+(?:temporary\\s+)?function\\b", 0, None),
    ("query", "^(select|with|values|table|from|\\()", 0, None),
]
# First words a statement of each kind can start with. A rule's regex runs only on
# statements with one of these first words, so each statement meets one or two regexes.
KIND_LEAD = {"explain": ("explain",), "insert_directory": ("insert",), "insert": ("insert", "from", "with"),
             "create_table_like": ("create",), "ctas": ("create",), "create_table": ("create",),
             "create_view": ("create",), "alter_view_as": ("alter",), "add_partition": ("alter",),
             "drop_partition": ("alter",), "add_columns": ("alter",),
             "recover_partitions": ("alter", "msck"), "drop_table": ("drop",),
             "show_create_table": ("show",), "create_database": ("create",),
             "drop_database": ("drop",), "alter_database": ("alter",), "set": ("set", "reset"),
             "rename_table": ("alter",), "set_properties": ("alter",), "alter_table": ("alter",), "alter_view": ("alter",),
             "drop_view": ("drop",), "describe_query": ("describe", "desc"), "describe": ("describe", "desc"),
             "describe_table": ("describe", "desc"), "refresh": ("refresh",), "refresh_table": ("refresh",),
             "uncache_table": ("uncache",), "comment_on_table": ("comment",), "show": ("show",), "use": ("use",),
             "replace_table_as": ("create", "replace"), "cache_table_as": ("cache",), "cache_table": ("cache",),
             "load_data": ("load",), "analyze_table": ("analyze",), "truncate_table": ("truncate",),
             "merge": ("merge",), "update": ("update",), "delete": ("delete",),
             "add_jar": ("add",), "create_function": ("create",), "drop_function": ("drop",),
             "query": ("select", "with", "values", "table", "from", "(")}
# Kinds whose table references come from the kind rule alone (no token walk).
COMMAND_KINDS = ("create_table_like", "add_partition", "drop_partition", "add_columns",
                 "recover_partitions", "drop_table", "show_create_table", "create_database",
                 "drop_database", "alter_database", "set", "add_jar", "create_function",
                 "drop_function", "cache_table", "rename_table", "set_properties", "alter_table", "alter_view", "drop_view",
                 "describe", "describe_table", "refresh", "refresh_table", "uncache_table", "comment_on_table", "show", "use", "load_data", "analyze_table", "truncate_table")
# Kinds whose target comes from the kind rule and whose inputs come from the token walk.
TARGET_KINDS = ("alter_view_as", "replace_table_as", "cache_table_as", "merge", "update", "delete")


def statement_head(sql: Column, quotes: str = "hive") -> Column:
    """Masked, comment-free, blank-squeezed text used by the kind rules (case kept; the
    rules match case-insensitively so that object names keep their case)."""
    return F.trim(F.regexp_replace(mask_literals(sql, quotes), "\\s+", " "))


def first_word(head: Column) -> Column:
    """Lower-cased first word (or '(') of a statement head."""
    return F.lower(F.regexp_extract(head, "^(\\(|[A-Za-z]+)", 1))


def classify_statement(head: Column, first: Column | None = None) -> Column:
    """Statement kind from the leading words; 'unknown' when no rule matches. Pass
    ``first`` (``first_word(head)`` as a column of its own) so that it is computed once; a
    rule's regex is only tried on statements whose first word can start that kind."""
    first = first_word(head) if first is None else first

    def chain(s: Column) -> Column:
        out = F.lit("unknown")
        for kind, pat, _, _ in reversed(KIND_RULES):
            out = F.when(s["first"].isin(*KIND_LEAD[kind]) & s["head"].rlike("(?i)" + pat), F.lit(kind)).otherwise(out)
        return out
    return _out_of_line(F.struct(head.alias("head"), first.alias("first")), chain)


def _unquote(c: Column) -> Column:
    return F.regexp_replace(c, "[`\"]", "")


def command_refs(head: Column, kind: Column) -> tuple[Column, Column]:
    """(input name, output name) that the kind rule itself gives, else nulls."""
    names = _out_of_line(F.struct(head.alias("head"), kind.alias("kind")), lambda s: F.struct(*(
        c.alias(n) for c, n in zip(_names_by_rule(s["head"], s["kind"]), ("ins", "outs")))))
    return names["ins"], names["outs"]


def _names_by_rule(head: Column, kind: Column) -> tuple[Column, Column]:
    ins, outs = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, pat, grp, role in KIND_RULES:
        if role is None:
            continue
        pat = "(?i)" + pat
        if grp == -1:   # two alternatives, each with its own group
            name = F.coalesce(F.when(F.regexp_extract(head, pat, 1) != "", F.regexp_extract(head, pat, 1)),
                              F.regexp_extract(head, pat, 2))
        else:
            name = F.regexp_extract(head, pat, grp)
        name = _unquote(name)
        if role == "like":
            src = _unquote(F.regexp_extract(head, pat, 2))
            ins = F.when(kind == k, src).otherwise(ins)
            outs = F.when(kind == k, name).otherwise(outs)
        elif role == "rename":   # the old name is read, the new one written
            ins = F.when(kind == k, name).otherwise(ins)
            outs = F.when(kind == k, _unquote(F.regexp_extract(head, pat, 2))).otherwise(outs)
        elif role == "merge":   # the source, unless it is a bracket
            src = _unquote(F.regexp_extract(head, pat, 3))
            ins = F.when((kind == k) & (src != ""), src).otherwise(ins)
            outs = F.when(kind == k, name).otherwise(outs)
        elif role == "in":
            ins = F.when(kind == k, name).otherwise(ins)
        else:
            outs = F.when(kind == k, name).otherwise(outs)
    return ins, outs
