"""Conversation structure repair by signature deduplication.

A row of a conversation becomes one letter, which says its role and its fault, and a conversation a
string of such letters. Conversations repeat few strings, so the cheapest edits of each distinct one
are found once, by a recursion that remembers what it found for the rest of a string, and are joined
back. Replaying them over the rows gives the repaired conversation.

Strings are cut into pieces of PIECE rows, however long a conversation is: a distinct piece gives the
costs between the states in which it may begin and end, one pass from a conversation's end says what
each of its endings costs, the piece is solved for these, and a pass from the start picks the state
in which each piece begins. Both passes go through sorted rows and hold one row. Rows get their
place by ranges of the sort order, not by a window over a conversation; only the digest of a
conversation, which no two tasks can share, reads its rows in one, a batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from skein.llm.common import scratch_path, skew_join

#: Rows in a piece of a signature.
PIECE = 128
#: Rows in an Arrow batch that goes back to Spark.
ROWS_OUT = 2_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Letters of the roles system, user, assistant and all others: rows without fault, truncated ones,
#: and those that must go.
CLEAN, CUT, DOOMED = "suao", "SUAO", "1234"
#: States of a repaired conversation by its last role: none yet, system, user, assistant.
STATES = range(4)
_NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
#: The state after the one role that may be added.
_ADDED = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
#: What is inserted to end a conversation in each state.
_ENDING = ("", "II", "I", "")
_IMPOSSIBLE = 1 << 40
_LEGAL = {"su", "ua", "au"}
_SPACES = " \t\n\x0b\f\r"


# Costs and edits of one signature


@lru_cache(1 << 17)
def to_go(signature: str, ends: tuple[int, ...]) -> tuple[int, ...]:
    """The least cost of a signature from each state on, inserts before a row included, where ends
    has the cost of what follows for each state in which it may end."""
    if not signature:
        return ends
    later, letter = to_go(signature[1:], ends), signature[0]
    row = [min(c for _, c, _ in _edits(letter, s, later)) for s in STATES]
    return tuple(min(row[s], INSERT + row[_ADDED[s]], 2 * INSERT + row[_ADDED[_ADDED[s]]]) for s in STATES)


def _edits(letter: str, state: int, later: tuple[int, ...]) -> Iterator[tuple[str, int, int]]:
    """Edits of one row that need no insert, with the least cost from there on, and the next state."""
    yield "D", DELETE + later[state], state
    if letter in DOOMED:
        return
    extra = TRUNCATED if letter in CUT else 0
    if (kept := _NEXT.get((letter.lower(), state))) is not None:
        yield "K", KEEP + extra + later[kept], kept
    yield "R", REROLE + extra + later[_ADDED[state]], _ADDED[state]


def matrix(signature: str) -> list[int]:
    """The costs from each state to each, row by row."""
    columns = [to_go(signature, tuple(0 if t == s else _IMPOSSIBLE for t in STATES)) for s in STATES]
    return [columns[t][s] for s in STATES for t in STATES]


def solve(signature: str, ends: tuple[int, ...], state: int) -> tuple[str, int]:
    """The cheapest edits, of equals the least string, and the state in which they end."""
    audit = []
    for i, letter in enumerate(signature):
        later = to_go(signature[i + 1 :], ends)
        while True:
            left = to_go(signature[i:], ends)
            ways = [x for x in _edits(letter, state, later) if x[1] == left[state]]
            if INSERT + left[_ADDED[state]] == left[state]:
                ways.append(("I", left[state], _ADDED[state]))
            edit, _, state = min(ways)
            audit.append(edit)
            if edit != "I":
                break
    return "".join(audit), state


LAST = tuple(INSERT * len(x) for x in _ENDING)


def _packed(ends: Iterable[int]) -> str:
    return ",".join(map(str, ends))


def _unpacked(ends: str) -> tuple[int, ...]:
    return tuple(map(int, ends.split(",")))


# Rows, faults, pieces


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copy (1 for a row's repetition) after damage by the checksum of
    `conv_id:turn`; null roles and texts become one space. Other columns are left out."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")), F.lit(20))
    role, text = said("role"), said("text")
    return conversations.where(kind != 0).select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    """common.written() with texts packed more densely."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, perhaps copy) with pos, which grows along each conversation
    by turn (nulls first), role, digest of the text, copy. Ranges of this order are sorted apart."""
    rows = rows if "copy" in rows.columns else rows.withColumn("copy", F.lit(0))
    bare = F.btrim("text", F.lit(_SPACES))
    ends = bare.endswith(".") | bare.endswith("!") | bare.endswith("?")
    rows = rows.select("conv_id", "turn", "role", "text", "copy", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), (bare == "").alias("blank"), (~ends).alias("cut"))
    by = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest"), F.col("copy")]
    return _stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("pos", F.monotonically_increasing_id()), "repair-rows")


def _letter(role: Column, fault: Column) -> Column:
    initial = F.substring(role, 1, 1)
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(fault.isin("blank", "duplicate"), F.translate(plain, CLEAN, DOOMED)).when(fault == "truncated", F.translate(plain, CLEAN, CUT)).otherwise(plain)


def faults(rows: DataFrame) -> DataFrame:
    """ordered() rows with each row's first fault: blank, duplicate (of an earlier role and text),
    truncated, or null. The first row of a role and text is found by an aggregate and joined on pos,
    so copies, however many, meet nowhere."""
    first = rows.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    return rows.select("conv_id", "turn", "role", "pos", "blank", "cut").join(first, "pos", "left").select("conv_id", "turn", "role", "pos", fault.alias("fault"))


def pieces(marked: DataFrame) -> DataFrame:
    """One row per piece of a conversation: signature, counts of faults, and its turns."""
    letters = F.array_sort(F.collect_list(F.struct("pos", _letter(F.col("role"), F.col("fault")).alias("x"))))
    count = lambda name: F.count(F.when(F.col("fault") == name, 1)).alias(name)
    return _stored(marked.groupBy("conv_id", F.expr(f"pos div {PIECE}").alias("piece")).agg(
        F.array_join(F.transform(letters, lambda x: x["x"]), "").alias("signature"), count("blank"), count("duplicate"), count("truncated"),
        F.min("turn").cast("long").alias("low"), F.max("turn").cast("long").alias("high"), F.size(F.collect_set("turn")).cast("long").alias("turns"),
    ), "repair-pieces")


# Solving and joining back


def _mapped(df: DataFrame, work, fields: list[tuple[str, T.DataType]], size: int = 10_000) -> DataFrame:
    """df through work, a function of an iterator of dicts to one of tuples; values stay Python's, so
    null keys and long numbers keep their type."""
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    names = [n for n, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, held = to_arrow_schema(schema), []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), arrow)], names=names)
        for row in work(x for b in batches for x in b.to_pylist()):
            held.append(row)
            if len(held) >= size:
                yield batch()
                held = []
        if held:
            yield batch()

    return df.mapInArrow(run, schema)


def _matrices(rows):
    for r in rows:
        yield r["signature"], _packed(matrix(r["signature"]))


def _backwards(rows):
    """From each conversation's last piece to its first: what follows a piece costs, by the state in
    which it ends, less the least of these, which every way has in common."""
    mine, ends = object(), LAST
    for r in rows:
        if r["conv_id"] != mine:
            mine, ends = r["conv_id"], LAST
        least = min(ends)
        here = tuple(x - least for x in ends)
        yield r["conv_id"], r["piece"], _packed(here)
        m = _unpacked(r["costs"])
        ends = tuple(min(m[4 * s + t] + here[t] for t in STATES) for s in STATES)


def _solutions(rows):
    for r in rows:
        ends = _unpacked(r["ends"])
        found = [solve(r["signature"], ends, s) for s in STATES]
        yield r["signature"], r["ends"], [a for a, _ in found], [s for _, s in found]


def spent(audit: str, signature: str) -> int:
    """The cost of an audit over its signature."""
    letters, total = iter(signature), 0
    for edit in audit:
        if edit == "I":
            total += INSERT
        else:
            letter = next(letters)
            total += DELETE if edit == "D" else (REROLE if edit == "R" else KEEP) + TRUNCATED * (letter in CUT)
    return total


def _plain(letter: str) -> str:
    return CLEAN[DOOMED.index(letter)] if letter in DOOMED else letter.lower()


def _forwards(rows):
    """From each conversation's first piece to its last: the audit of each piece, with the inserts
    that end the conversation after the last."""
    mine, state, before, high, last = object(), 0, "", None, None

    def ended():
        if last:
            end = _ENDING[state]
            yield *last[:2], last[2] + end, last[3] + INSERT * len(end), *last[4:]

    for r in rows:
        new = r["conv_id"] != mine
        if new:
            yield from ended()
            mine, state, before, high = r["conv_id"], 0, "", None
        elif last:
            yield last
        audit, signature = r["audits"][state], r["signature"]
        state = r["exits"][state]
        line = before + "".join(map(_plain, signature))
        illegal = sum(line[i : i + 2] not in _LEGAL for i in range(len(line) - 1))
        turns = r["turns"] - (high is not None and r["low"] == high)
        before, high = line[-1], r["high"] if r["high"] is not None else high
        last = r["conv_id"], r["piece"], audit, spent(audit, signature), illegal, turns
    yield from ended()


def audits(found: DataFrame) -> DataFrame:
    """conv_id, piece, audit, cost, illegal and turns (those not in the piece before) of pieces()."""
    text, long, ids = T.StringType(), T.LongType(), found.schema["conv_id"].dataType
    matrices = _mapped(found.select("signature").distinct(), _matrices, [("signature", text), ("costs", text)])
    with_costs = skew_join(found.select("conv_id", "piece", "signature"), _stored(matrices, "repair-costs"), ["signature"])
    along = lambda df, order: df.repartition("conv_id").sortWithinPartitions("conv_id", order)
    ends = _mapped(along(with_costs, F.desc("piece")), _backwards, [("conv_id", ids), ("piece", long), ("ends", text)])
    # A piece number belongs to one range of the order, so to few conversations.
    ended = _stored(found.alias("f").join(ends.alias("e"), F.expr("f.piece = e.piece and f.conv_id <=> e.conv_id")).select("f.*", "e.ends"), "repair-ends")
    fields = [("signature", text), ("ends", text), ("audits", T.ArrayType(text)), ("exits", T.ArrayType(T.IntegerType()))]
    solved = _stored(_mapped(ended.select("signature", "ends").distinct(), _solutions, fields), "repair-solved")
    ways = skew_join(ended.select("conv_id", "piece", "signature", "ends", "low", "high", "turns"), solved, ["signature", "ends"])
    out = [("conv_id", ids), ("piece", long), ("audit", text), ("cost", long), ("illegal", long), ("turns", long)]
    return _stored(_mapped(along(ways, "piece"), _forwards, out), "repair-audits")


# Replaying


def _replay(rows):
    """(conv_id, place, role, text, edit) of repaired conversations, from the audit of each piece and
    then its rows. Holds one audit."""
    mine, state, place, todo = object(), 0, 0, iter("")

    def inserts(until_row: bool):
        nonlocal state, place
        for edit in todo:
            if edit != "I":
                return edit
            state, place = _ADDED[state], place + 1
            yield mine, place, _ROLE[state], "", "I"
        assert not until_row, "an audit ends before its rows"

    for r in rows:
        if r["pos"] is None:
            # Only the last audit of a conversation ends in inserts.
            yield from inserts(False)
            if r["conv_id"] != mine:
                mine, state, place = r["conv_id"], 0, 0
            todo = iter(r["text"])
            continue
        edit = yield from inserts(True)
        if edit == "D":
            continue
        state = _ADDED[state] if edit == "R" else _NEXT[r["role"][:1], state]
        place += 1
        yield mine, place, _ROLE[state] if edit == "R" else r["role"], r["text"], edit
    yield from inserts(False)


def _digests(rows):
    mine, digest = object(), None
    for conv_id, _, role, text, _ in _replay(rows):
        if digest is None or conv_id != mine:
            if digest is not None:
                yield mine, digest.hexdigest()
            mine, digest = conv_id, hashlib.sha256()
        else:
            digest.update(b"\n")
        digest.update(f"{role}:{text}".encode())
    if digest is not None:
        yield mine, digest.hexdigest()


class Repair:
    """The steps' stored results for rows with conv_id, turn, role and text."""

    def __init__(self, rows: DataFrame):
        self.rows = ordered(rows)
        self.marked = faults(self.rows)
        self.pieces = pieces(self.marked)
        self.audits = audits(self.pieces)

    def _lines(self) -> DataFrame:
        """Audits, each before the rows of its piece, sorted within conversations."""
        rows = self.rows.select("conv_id", F.expr(f"pos div {PIECE}").alias("piece"), "pos", "role", "text")
        heads = self.audits.select("conv_id", "piece", F.lit(None).cast("long").alias("pos"), F.lit("").alias("role"), F.col("audit").alias("text"))
        return heads.union(rows).repartition("conv_id").sortWithinPartitions("conv_id", "piece", F.asc_nulls_first("pos"))

    def repaired(self) -> DataFrame:
        """The repaired rows: conv_id, place (from 1), role, text, and the edit that made each."""
        text = T.StringType()
        fields = [("conv_id", self.rows.schema["conv_id"].dataType), ("place", T.LongType()), ("role", text), ("text", text), ("edit", text)]
        return _mapped(self._lines(), _replay, fields, ROWS_OUT)

    def digests(self) -> DataFrame:
        return _mapped(self._lines(), _digests, [("conv_id", self.rows.schema["conv_id"].dataType), ("sha256", T.StringType())], ROWS_OUT)

    def report(self, ids: DataFrame) -> DataFrame:
        """One row for each conv_id of ids: gaps, counts of faults, illegal pairs, cost, audit and the
        digest of the repaired rows."""
        nothing = lambda *names: [F.lit(None).cast("long").alias(n) for n in names]
        sums, none = ["blank", "duplicate", "truncated", "low", "high"], F.lit(None).cast("string")
        part = lambda df, *own: df.select("conv_id", *own)
        rows = part(ids.select("conv_id").distinct(), *nothing(*sums, "piece", "cost", "illegal", "turns"), none.alias("audit"), none.alias("sha256"))
        rows = rows.union(part(self.pieces, *sums, *nothing("piece", "cost", "illegal", "turns"), none, none))
        rows = rows.union(part(self.audits, *nothing(*sums), "piece", "cost", "illegal", "turns", "audit", none))
        rows = rows.union(part(self.digests(), *nothing(*sums, "piece", "cost", "illegal", "turns"), none, "sha256"))
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
        audit = F.array_sort(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("piece", "audit"))))
        return rows.groupBy("conv_id").agg(
            F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).alias("gaps"), total("blank"), total("duplicate"), total("truncated"), total("illegal"), total("cost"),
            F.array_join(F.transform(audit, lambda x: x["audit"]), "").alias("audit"),
            F.coalesce(F.max("sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )


def repair(rows: DataFrame) -> Repair:
    """Finds and replays the cheapest edits after which each conversation's role initials read
    `(s?(ua)+)?`: rows are kept, given the role that fits, deleted, or inserted empty.

    Defined results: a null conv_id is a conversation of its own; null turns come first and count in no
    gap; rows of one turn are taken by role, digest of the text and copy; role and text must not be
    null (damage() makes them one space); roles other than system, user and assistant count by their
    initial, an empty role by none; repeated rows are duplicates but the first; an empty table gives
    no rows; other columns are ignored.
    """
    return Repair(rows)


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damage(conversations)).report(conversations)


#: The checksum is worked out byte by byte from a table made of its polynomial; edits go forward row by
#: row, keeping of each state the cheapest, of equals the least, and the lines it has so far.
OP11_SQL = r"""WITH RECURSIVE gen(b, v, k) AS (SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i) UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM gen WHERE k < 8),
tb AS (SELECT list(v ORDER BY b) AS t FROM gen WHERE k = 8),
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM conversations, tb),
c AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM d WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM c),
f AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
ins(s, t, c, a, more) AS (VALUES (0, 0, 0, '', []), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 1, 0, '', []), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []), (2, 3, 3, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 3, 'I', ['user:'])),
w(conv_id, i, s, cost, audit, lines) AS (SELECT DISTINCT conv_id, 1::BIGINT, 0, 0, '', []::VARCHAR[] FROM f UNION ALL
  SELECT conv_id, i, s, struct_extract_at(min((cost, audit)), 1), struct_extract_at(min((cost, audit)), 2), arg_min(lines, (cost, audit)) FROM (SELECT conv_id, i, s, cost, audit, lines FROM (
    SELECT w.conv_id, w.i + 1 AS i, CASE k WHEN 'D' THEN t WHEN 'R' THEN CASE t WHEN 2 THEN 3 ELSE 2 END ELSE CASE WHEN left(role, 1) = 's' AND t = 0 THEN 1 WHEN left(role, 1) = 'u' AND t IN (0, 1, 3) THEN 2 WHEN left(role, 1) = 'a' AND t = 2 THEN 3 END END AS s,
      cost + ins.c + CASE k WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN k <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS cost, audit || a || k AS audit,
      list_concat(list_concat(lines, more), CASE k WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [CASE t WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] END) AS lines
    FROM w JOIN ins ON ins.s = w.s JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i JOIN (VALUES ('D'), ('K'), ('R')) e(k) ON k = 'D' OR fault NOT IN ('blank', 'duplicate')) WHERE s IS NOT NULL) GROUP BY conv_id, i, s),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1),
z AS (SELECT w.conv_id, struct_extract_at(min((cost + c, audit || a)), 1) AS cost, struct_extract_at(min((cost + c, audit || a)), 2) AS audit, arg_min(list_concat(lines, more), (cost + c, audit || a)) AS lines FROM w JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = n.n + 1 JOIN ins ON ins.s = w.s AND t IN (0, 3) GROUP BY 1)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM q.conv_id"""
