"""Problem 3: files that nobody wrote by hand in their repository.

Three kinds of evidence, each alone enough: the path (generator suffixes, bundles, third-party
folders), the content (banners at the top, minified or data-like composition), and other
repositories (lines of the file, rarest first, found in an earlier file of another
repository, or in a third-party copy of any date there: an inverted index of the line hashes of all
files with an exact containment check). Files with equal lines are one class, and a class is told by its
earliest files, so a library that stands in any number of repositories gives rows in proportion.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.ids import norm_id
from tamis.plans.runtime import cut, spread

#: Share of a file's lines that must stand in one other file for it to be a copy.
CONTAINED = 0.8
#: Lines shorter than this say nothing; files with fewer lines are too small to be told copies.
LINE_CHARS, LEAST_LINES = 20, 8
#: Shorter texts are small files, never minified or data.
SMALL_CHARS = 200
#: Share of a file's characters on data lines that makes it data saved as code.
DATA_SHARE = 0.7

#: Folders of third-party code, and build output.
FOLDERS = re.compile(
    r"(?:^|/)generated/|(?:^|/)(?:vendor|_vendor|node_modules|bower_components|third_party|third-party|thirdparty|site-packages|dist-packages|Godeps|Carthage|Pods|\.yarn|jspm_packages|\.venv|venv/lib|virtualenv)/"
    r"|(?:^|/)(?:external|deps)/(?:[^/]*\.example/|[^/]*\.(?:com|org|net|io|dev)/|[^/]+-v?\d+\.\d+)",
)
BUILT = re.compile(r"(?:^|/)dist/[^/]+\.(?:js|css|mjs)$")
#: Names that generators, minifiers and bundlers give.
NAMES = re.compile(
    r"\.pb(?:\.\w+)?\.(?:go|cc|h|c|js|ts|swift|py)$|_pb2(?:_grpc)?\.pyi?$|_pb\.(?:js|d\.ts|rb)$|_grpc\.pb\.go$|\.pb\.gw\.go$"
    r"|\.(?:generated|gen|g|designer)\.\w+$|_generated\.\w+$|_gen\.go$|^zz_generated|(?:^|_)generated(?:_|\.)|^mock_\w+\.go$|_mock\.gen\.go$|_string\.go$|_easyjson\.go$|bindata\.go$|\.deepcopy\.go$"
    r"|[.-]min\d*\.(?:js|css|mjs)$|\.bundle\d*\.(?:js|css|mjs)$|\.chunk\d*\.(?:js|css|mjs)$|[.-][0-9a-f]{8,20}\.(?:js|css|mjs)$|\.(?:js|css)\.map$"
    r"|^lex\.\w+\.(?:c|cc|cpp)$|^y\.tab\.[ch]$|\.(?:tab|yy|lex)\.(?:c|cc|cpp|h|hh|hpp)$|(?:Lexer|Parser|Listener|Visitor)\.(?:interp|tokens)$|^moc_\w+\.cpp$|^ui_\w+\.h$|^qrc_\w+\.cpp$|_wrap\.(?:c|cxx|cpp)$|\.pb-c\.[ch]$|_pb\.(?:go|dart)$|\.(?:thrift|avsc|capnp|fbs)\.(?:go|h|js|c\+\+)$|_rpc\.pb\.\w+$|wire_gen\.go$|(?:^|_)enum(?:er|s_gen)\.go$"
    r"|^bindata_\w+\.go$|^font_\w+\.js$|_table\.c$|_image\.h\.c$|\.xpm$|\.xbm$|(?<=[a-z_])(?:_data\.(?:go|c|h|py|js)|Data\.java)$|_(?:corpus|weights|embeddings|vectors|vocab|dump)\.json$",
)
#: Folders and banners of third-party copies.
THIRD_FOLDERS = re.compile(FOLDERS.pattern.removeprefix("(?:^|/)generated/|"))
_TAKEN = r"\b(?:vendored|imported|copied|taken|synced|mirrored|pulled|forked|borrowed)(?: (?:verbatim|unmodified|unchanged|directly|as is))*,? from (?:upstream\b|https?://|[\w.-]+/[\w.-]+|[\w.-]+ (?:release|version|v?\d+\.\d))|\bvendored from\b|\bupstream copy\b|\bbundled third-party\b|\bthird-party library\b|\bkept here (?:unmodified|unchanged|verbatim)\b|\blocal (?:changes|edits|modifications) (?:are not allowed|are forbidden|will be (?:lost|overwritten))"
THIRD_BANNER = re.compile(_TAKEN, re.I)
#: What banners say, and how they are denied.
BANNER = re.compile(
    r"code generated (?:by|from)\b|@generated\b|<auto-?generated>|\bauto(?:matically)?[ -]?generated\b|\bgenerated (?:on build|automatically|by|from|file|code|with)\b|\bmachine[- ]generated\b"
    r"|\bdo not (?:edit|modify)\b|\bcompiled output\b|\bedit the source instead\b|\bchanges will be lost\b|\binstead of editing\b"
    rf"|{_TAKEN}",
    re.I,
)
DENIED = re.compile(r"\b(?:not|nothing|never|no|isn't|don't|wasn't|without|by hand)\b(?! (?:edit|modify)\b).{0,40}\b(?:generat|vendored)|written by hand|edit freely|banner of|vendored copy was|do not run|['\"`]do not edit|our own version", re.I)
COMMENT_LINE = re.compile(r"^\ufeff?\s*(?://|/\*|\*|#|--|;|%|<!--|\"\"\"|'''|REM\b)")
#: Lines read for a banner at least; comments and blank lines on top are read to their end.
BANNER_LINES = 15
DIRECTIVE = re.compile(r"^#\s*(?:include|define|undef|if|ifdef|ifndef|elif|else|endif|pragma|import|error)\b")
CODE = re.compile(r"\.(?:go|py|js|mjs|jsx|ts|tsx|java|c|h|cc|cpp|hpp|cs|rb|php|rs|kt|swift|scala|m|lua|pl|sh|css)$", re.I)
LICENCE = re.compile(r"(?:^|/)(?:(?:un)?licen[cs]e|copying|notice)(?:[._-][\w.-]+)?$", re.I)
#: A line of numbers, bytes, records or encoded data, quoted or not.
DATA_LINE = re.compile(
    r"^[\s\"'`+]*(?:(?:0x[0-9a-fA-F]{1,16}|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|\\x[0-9a-fA-F]{2})[\s,;|]*){4,}[\s\"'`+,\\\])};]*$"
    r"|^[\s\"'`+]*(?:[\w.+-]+[,;|\t]){2,}[\w.+-]*[\s\"'`+,\\\])};]*$"
    r"|^[\s\"'`+]*[A-Za-z0-9+/=]{40,}[\s\"'`+,\\\])};]*$|^[\s\"'`+]*(?:\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}){4,}.*$"
)
LONG_BLOB = re.compile(r"[A-Za-z0-9+/=]{120,}|(?:\\x[0-9a-fA-F]{2}){30,}|(?:0x[0-9a-fA-F]{2},\s*){30,}|(?:-?\d+(?:\.\d+)?,\s*){40,}")
NUMBERS = re.compile(r"(?:-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?[\s,\]\[]*){30,}")
PEM = re.compile(r"-----BEGIN [A-Z ]+-----.*?-----END [A-Z ]+-----", re.S)


def clean_path(path: str | None) -> str:
    """Forward slashes, without leading ``./`` and drive."""
    return re.sub(r"^(?:[A-Za-z]:)?(?:\./+)*", "", (path or "").strip().replace("\\", "/"))


def by_path(path: str | None) -> bool:
    """The path alone shows a generated, bundled, third-party or data file."""
    p = clean_path(path)
    if not p or LICENCE.search(p):
        return False
    return bool(FOLDERS.search("/" + p) or BUILT.search("/" + p) or NAMES.search(p.rsplit("/", 1)[-1]))


def banner(text: str, says: re.Pattern = BANNER) -> str | None:
    """The first line of the comments on top that is a banner."""
    lines = text.removeprefix("\ufeff").split("\n")
    inside = code = False
    for at, line in enumerate(lines):
        s = line.strip()
        code = code or bool(s) and not inside and (not COMMENT_LINE.match(line) or bool(DIRECTIVE.match(s)))
        if code and at >= BANNER_LINES:
            break
        if inside or COMMENT_LINE.match(line):
            if says.search(line) and not DENIED.search(line):
                return line
        if re.match(r"/\*|<!--", s):
            inside = True
        if re.match(r"\"\"\"|'''", s) and s[3:].find(s[:3]) < 0:
            inside = not inside
        if re.search(r"\*/|-->", s) or inside and s.endswith(('"""', "'''")) and len(s) > 3 and not s.startswith(('"""', "'''")):
            inside = False
    return None


def third_party(path: str | None, text: str | None) -> str | None:
    """What shows a third-party copy, its path or banner, with ``_`` for ``/``; None for other files."""
    p = clean_path(path)
    if THIRD_FOLDERS.search("/" + p):
        return p.lower().replace("/", "_")
    line = banner(text.replace("\r\n", "\n").replace("\r", "\n"), THIRD_BANNER) if text else None
    return line.lower().replace("/", "_") if line else None


def by_content(path: str | None, text: str | None) -> bool:
    """A banner in the comments on top, or a minified or data-like composition."""
    if not text or not text.strip() or LICENCE.search(clean_path(path)):
        return False
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    if banner(text):
        return True
    if len(text) < SMALL_CHARS:
        return False
    if not CODE.search(clean_path(path)):
        # Configuration is written by hand; a table of numbers as JSON is data.
        return clean_path(path).lower().endswith(".json") and sum(len(m) for m in NUMBERS.findall(text)) > 0.8 * len(text)
    body = PEM.sub("", text)
    rows = [x for x in body.split("\n") if x.strip()]
    code = [x for x in rows if not COMMENT_LINE.match(x)]
    size = sum(map(len, code))
    if size < SMALL_CHARS:
        return False
    if any(len(x) > 300 for x in code):
        long = [x for x in code if len(x) > 300]
        packed = sum(map(len, long))
        blanks = sum(x.count(" ") + x.count("\t") for x in long) / packed
        marks = sum(x.count(";") + x.count("{") + x.count("(") + x.count(",") + x.count("=") for x in long) / packed
        if packed > 0.7 * size and blanks < 0.15 and marks > 0.06:
            return True
    data = sum(len(x) for x in code if DATA_LINE.match(x) or len(x) > 200 and sum(len(m) for m in LONG_BLOB.findall(x)) > 0.6 * len(x))
    return data > DATA_SHARE * size


def _scan(docs: DataFrame) -> DataFrame:
    """``ord, repo, at, found, third, lines``: evidence of its own, what shows a third-party copy, and
    hashes of the distinct lines."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def hashes(path: str | None, text: str | None) -> list[int]:
            if not text or LICENCE.search(clean_path(path)):
                return []
            out = {" ".join(x.split()) for x in text.replace("\r", "\n").split("\n")}
            kept = [x for x in out if len(x) >= LINE_CHARS]
            return [xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in kept] if len(kept) >= LEAST_LINES else []

        for b in batches:
            paths, texts = b.column("file_path").to_pylist(), b.column("content").to_pylist()
            found = [by_path(p) or by_content(p, t) for p, t in zip(paths, texts)]
            third = [third_party(p, t) if f else None for f, p, t in zip(found, paths, texts)]
            lines = [hashes(p, t) for p, t in zip(paths, texts)]
            yield pa.RecordBatch.from_arrays([b.column("ord"), b.column("repo"), b.column("at"), pa.array(found, pa.bool_()), pa.array(third, pa.string()), pa.array(lines, pa.list_(pa.int64()))], ["ord", "repo", "at", "found", "third", "lines"])

    src = spread(docs.select("ord", norm_id(F.col("repo")).alias("repo"), F.col("read_at").cast("timestamp_ntz").alias("at"), "file_path", "content"))
    return src.mapInArrow(run, "ord bigint, repo string, at timestamp_ntz, found boolean, third string, lines array<bigint>")


def _heads(rows: DataFrame, key: str) -> DataFrame:
    """``key, heads``: the first row by (at, ord) and the first of another repository, as structs, of
    ``rows(key, repo, at, ord, third)``. Both come from aggregations with map-side combine."""
    each = rows.groupBy(key, "repo").agg(F.min(F.struct("at", "ord", "third")).alias("h")).select(key, F.struct("h.at", "h.ord", "repo", "h.third").alias("x"))
    one = each.groupBy(key).agg(F.min("x").alias("a"))
    two = each.join(one, key).where("x.repo <> a.repo").groupBy(key).agg(F.min("x").alias("b"))
    return one.join(two, key, "left").select(key, F.array_compact(F.array("a", "b")).alias("heads"))


def _copied(heads: str, third: str) -> Column:
    """A file (repo, name, at, ord) is later than a head of another repository, or has a third-party copy there that doesn't
    name its own."""
    earlier = F.exists(heads, lambda x: (x["repo"] != F.col("repo")) & (F.struct(x["at"], x["ord"]) < F.struct(F.col("at"), F.col("ord"))))
    foreign = F.exists(third, lambda x: (x["repo"] != F.col("repo")) & ~F.contains(x["third"], F.regexp_replace("name", "/", "_")))
    return F.coalesce(earlier, F.lit(False)) | F.coalesce(foreign, F.lit(False))


def foreign_copies(files: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """``ord`` of files of which at least ``contained`` of the lines stand in an earlier file of
    another repository, or in a third-party copy there, whatever its date, unless the earliest two such copies (of two
    repositories) of each content name the file's own as their source. ``files(ord, repo, at, found, third, lines)``; files
    found already are looked up but not told; null repositories are left out.

    Files with equal lines are one class, kept by its earliest files. A class that is contained to that share in
    another holds one of its ``(1 - contained) n + 1`` rarest lines there, whatever those are: only these
    are looked up, and nothing is missed. The earliest class with such a line is tried first; only files that it
    doesn't explain are looked up in all classes with their lines.
    """
    files = files.where("repo is not null and size(lines) > 0").select("ord", F.xxhash64("repo").alias("repo"), F.col("repo").alias("name"), "at", "found", "third", F.sort_array("lines").alias("lines"))
    files = files.withColumn("cls", F.xxhash64("lines"))
    members = cut(files.drop("lines"))
    heads = _heads(members.withColumn("third", F.lit(None).cast("string")), "cls")
    thirds = _heads(members.where("third is not null"), "cls").withColumnRenamed("heads", "thirds")
    whole = files.groupBy("cls").agg(F.first("lines").alias("lines"), F.bool_or(~F.col("found")).alias("asked"), F.min("repo").alias("r1"), F.max("repo").alias("r2"))
    classes = cut(whole.join(heads, "cls").join(thirds, "cls", "left"))
    asked = members.where("not found").select("cls", "ord", "repo", "name", "at")

    def told(by: DataFrame, who: DataFrame) -> DataFrame:
        """Files of ``who`` that the heads of ``by(cls, heads, thirds)`` explain."""
        return who.join(by, "cls").where(_copied("heads", "thirds")).select("ord")

    same = cut(told(classes.select("cls", "heads", "thirds"), asked))
    left = cut(asked.join(same, "ord", "left_anti"))
    lines = classes.select("cls", "r1", "r2", F.col("heads")[0]["at"].alias("at"), F.col("heads")[0]["ord"].alias("ord"), F.explode("lines").alias("h"))
    held = lines.groupBy("h").agg(F.count("*").alias("df"), F.min("r1").alias("r1"), F.max("r2").alias("r2"), F.min(F.struct("at", "ord", "cls"))["cls"].alias("first")).where("df > 1 and r1 <> r2").select("h", "df", "first")
    open_ = classes.join(left.select("cls").distinct(), "cls", "left_semi").select("cls", "lines")
    shared = open_.select("cls", F.explode("lines").alias("h")).join(held, "h").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "h", "first"))).alias("s"))
    # Lines of one repository, or of one class, can't point elsewhere; a class with more of them than it may miss is no copy.
    n = F.size("lines")
    spare = n - F.ceil(n * contained).cast("int")
    probes = open_.join(shared, "cls").withColumn("unshared", n - F.size("s")).where(F.col("unshared") <= spare)
    probes = cut(probes.select("cls", F.explode(F.slice("s", F.lit(1), spare - F.col("unshared") + 1)).alias("x")).select("cls", "x.h", "x.first"))

    def explained(pairs: DataFrame) -> DataFrame:
        """``cls, heads, thirds`` of each class that contains ``cls``, of ``pairs(cls, other)``. Of equal files only those of
        the earliest repository are left by now."""
        a = classes.select("cls", F.col("lines").alias("l1"))
        b = classes.select(F.col("cls").alias("other"), F.col("lines").alias("l2"), "heads", "thirds")
        return pairs.join(a, "cls").join(b, "other").where(F.size(F.array_intersect("l1", "l2")) >= F.size("l1") * contained).select("cls", "heads", "thirds")

    first = cut(told(explained(probes.where("first <> cls").select("cls", F.col("first").alias("other")).distinct()), left).distinct())
    rest = cut(left.join(first, "ord", "left_anti"))
    again = probes.join(rest.select("cls").distinct(), "cls", "left_semi")
    pairs = cut(again.join(lines.select(F.col("cls").alias("other"), "h"), "h").where("cls <> other").select("cls", "other").distinct())
    return same.unionByName(first).unionByName(told(explained(pairs), rest)).distinct()


def not_handwritten(docs: DataFrame, downloads: DataFrame) -> DataFrame:
    """``tbl, ord`` of rows whose file is generated, minified, bundled, third-party or data.

    documents_raw rows by path or content, download_results rows by local_path alone. Null paths
    of downloads never count, null or blank content leaves the path, repeated rows are kept;
    licence files, configuration and small files are never told by composition.
    """
    import pyarrow as pa

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([by_path(p) for p in b.column("local_path").to_pylist()], pa.bool_())).select(["ord"])

    files = cut(_scan(docs))
    own = files.where("found").select("ord")
    of_docs = own.unionByName(foreign_copies(files))
    of_downloads = downloads.where("local_path is not null").select("ord", "local_path").mapInArrow(paths, "ord bigint")
    return of_docs.select(F.lit("documents_raw").alias("tbl"), "ord").unionByName(of_downloads.select(F.lit("download_results").alias("tbl"), "ord"))
