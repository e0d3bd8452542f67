"""DuckDB SQL equivalents of the registered queries, written per token and per line with
plain window functions (the oracle need not scale; it must be obviously right).

Building blocks are CTE snippets; each query string is ``WITH <snippets> SELECT ...``.
"""

from __future__ import annotations

from tokenloom.functions.text import byte_char_table
from tokenloom.operators.bpe import PER_ROUND, ROUNDS
from tokenloom.plans.queries import B, BIN_CUTS, BIN_DIM, C, CFG, CLAMP, ENTRY_B, ENTRY_T, LONG_CLAMP, LONG_MEM, LONG_T, MEM, SEED, SHARD_CFG, SHUFFLES, T, TAIL_CUTS, bin_projection

NL = "chr(10)"

LINES = f"""
docs AS (SELECT doc_id, source AS shard, text, string_split(text, {NL}) AS parts FROM documents),
lines0 AS (SELECT shard, doc_id, text, unnest(parts) AS line, unnest(range(0, len(parts))) AS line_no,
                  len(parts) AS np FROM docs),
lines AS (SELECT shard, doc_id, CAST(line_no AS BIGINT) AS line_no, line,
                 (line_no < (CASE WHEN ends_with(text, {NL}) THEN np - 1 ELSE np END) - 1)
                   OR ends_with(text, {NL}) AS has_newline
          FROM lines0
          WHERE text <> '' AND NOT (ends_with(text, {NL}) AND line_no = np - 1))"""


def words(lower: bool = False, col: str = "line") -> str:
    src = f"lower({col})" if lower else col
    return f"list_filter(string_split_regex({src}, '\\s+'), lambda x: x <> '')"


def tokens_cte(name: str, marks: bool, lines: str = "lines", lower: bool = False, extra_order: str = "",
               part: str = "") -> str:
    """Tokens with their concatenation position p (per ``part`` when given) and the line's
    symbol count ``nsym``."""
    sy = f"list_concat({words(lower)}, ['<eos>'])" if marks else words(lower)
    over = (f"PARTITION BY {part} " if part else "") + "ORDER BY " + ((extra_order + ", ") if extra_order else "") + "doc_id, line_no, pos"
    extra = (", " + extra_order) if extra_order else ""
    extra += (", " + part) if part and part != extra_order else ""
    return f"""
{name}_s AS (SELECT *, {sy} AS symbols FROM {lines}),
{name}_0 AS (SELECT doc_id, line_no, len(symbols) AS nsym, unnest(symbols) AS sym, unnest(range(0, len(symbols))) AS pos
             {extra} FROM {name}_s),
{name} AS (SELECT *, row_number() OVER ({over}) - 1 AS p FROM {name}_0)"""


# counting order key: document, line, token in the line as the digits of one number
KEY = "CAST(doc_id AS HUGEINT) * 100000000000000000 + line_no * 1000000000 + pos"
COUNTS = tokens_cte("ctok", marks=True) + f""",
counts AS (SELECT sym, count(*) AS cnt, CAST(min({KEY}) AS VARCHAR) AS first_key, min(p) AS first FROM ctok WHERE pos < nsym - 1 GROUP BY sym)"""

SPECIALS = """
specials AS (SELECT * FROM (VALUES ('<eos>', 0), ('<unk>', 1)) t(sym, id))"""


def bpe_sql(pretokens: str) -> dict[str, str]:
    """Merges learned in rounds over all pre-tokens by string replacement, pieces by a recursive query that
    joins the lowest-ranked pair of each word first, and counts of piece ids."""
    o, c = "chr(57344)", "chr(57345)"  # around each piece
    parts = f"string_split(s[2:-2], {c} || {o})"
    ctes = [f"""{pretokens},
bm AS (SELECT {BYTE_MAP} AS m),
wd AS (SELECT token, count(*) AS cnt FROM bt WHERE token <> '' GROUP BY token),
w0 AS (SELECT token, cnt, {o} || array_to_string(list_transform(regexp_extract_all(hex(encode(token)), '..'), lambda h: m[h]), {c} || {o}) || {c} AS s FROM wd, bm),
m0 AS (SELECT 0 AS rank, '' AS l, '' AS r WHERE false)"""]
    for k in range(ROUNDS):
        ctes.append(f"""x{k} AS (SELECT cnt, {parts} AS x FROM w{k}),
p{k} AS (SELECT cnt, unnest(x[:-2]) AS l, unnest(x[2:]) AS r FROM x{k} WHERE len(x) > 1),
t{k} AS (SELECT l, r, row_number() OVER (ORDER BY n DESC, l, r) - 1 AS i FROM (
  SELECT l, r, sum(cnt) AS n FROM p{k} WHERE (l, r) NOT IN (SELECT (l, r) FROM m{k}) GROUP BY l, r) ORDER BY n DESC, l, r LIMIT {PER_ROUND}),
m{k + 1} AS (SELECT * FROM m{k} UNION ALL SELECT i + (SELECT count(*) FROM m{k}), l, r FROM t{k})""")
        s = "s"
        for i in range(PER_ROUND):
            pair = f"(SELECT {{}} FROM t{k} WHERE i = {i})"
            old = pair.format(f"{o} || l || {c} || {o} || r || {c}")
            new = pair.format(f"{o} || l || r || {c}")
            s = f"replace({s}, coalesce({old}, {o} || {o}), coalesce({new}, {o} || {o}))"
        ctes.append(f"w{k + 1} AS MATERIALIZED (SELECT token, cnt, {s} AS s FROM w{k})")
    learned = "WITH RECURSIVE " + ",\n".join(ctes)
    merges = f"SELECT CAST(rank AS BIGINT) AS rank, l AS \"left\", r AS \"right\" FROM m{ROUNDS}"
    pieces = f""",
mm AS (SELECT rank, {o} || l || {c} || {o} || r || {c} AS old, {o} || l || r || {c} AS new, l || r AS piece FROM m{ROUNDS}),
st AS (SELECT token, s FROM w0 UNION ALL
       SELECT st.token, replace(st.s, arg_min(mm.old, mm.rank), arg_min(mm.new, mm.rank)) FROM st JOIN mm ON contains(st.s, mm.old) GROUP BY st.token, st.s),
fin AS (SELECT token, s FROM st WHERE NOT EXISTS (SELECT 1 FROM mm WHERE contains(st.s, mm.old)))"""
    counts = f""",
base AS (SELECT unnest(map_values(m)) AS piece, unnest(map_keys(m)) AS h FROM bm),
made AS (SELECT piece, min(rank) AS rank FROM mm WHERE piece NOT IN (SELECT piece FROM base) GROUP BY piece),
ids AS (SELECT piece, row_number() OVER (ORDER BY h) - 1 AS id FROM base UNION ALL
        SELECT piece, 255 + row_number() OVER (ORDER BY rank) FROM made),
pc AS (SELECT unnest({parts}) AS piece, cnt FROM fin JOIN wd USING (token))
SELECT CAST(id AS BIGINT) AS id, CAST(sum(cnt) AS BIGINT) AS cnt FROM pc JOIN ids USING (piece) GROUP BY id"""
    ids = counts[:counts.index("pc AS")]
    examples = f""",
tp AS (SELECT token, {parts} AS ps FROM fin),
tq AS (SELECT token, unnest(ps) AS piece, unnest(range(0, len(ps))) AS k FROM tp),
ti AS (SELECT token, list(CAST(id AS BIGINT) ORDER BY k) AS tids FROM tq JOIN ids USING (piece) GROUP BY token),
sh AS (SELECT shard, row_number() OVER (ORDER BY shard) - 1 AS shard_no FROM (SELECT DISTINCT source AS shard FROM documents)),
tk AS (SELECT b.doc_id, b.line_no, b.tok_no, printf('train-%03d', sh.shard_no) || '.bsz-{B}.tlen-{T}.core-{C}' AS basename, ti.tids
       FROM bt b JOIN ti USING (token) JOIN documents d ON d.doc_id = b.doc_id JOIN sh ON sh.shard = d.source WHERE sh.shard_no > 1),
flat AS (SELECT basename, doc_id, line_no, tok_no, unnest(tids) AS id, unnest(range(0, len(tids))) AS k FROM tk),
placed AS (SELECT basename, id, row_number() OVER (PARTITION BY basename ORDER BY doc_id, line_no, tok_no, k) - 1 AS p, count(*) OVER (PARTITION BY basename) // {B} AS S FROM flat),
g AS (SELECT basename, p // S AS r, p % S AS c, id, S FROM placed WHERE p < {B} * S),
i AS (SELECT basename, r, c // {T} AS w, count(*) AS n, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY c) AS inputs FROM g WHERE c < S - 1 GROUP BY ALL),
l AS (SELECT basename, r, (c - 1) // {T} AS w, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY c) AS labels FROM g WHERE c >= 1 GROUP BY ALL)
SELECT basename, w * {B} + r AS sample_id, inputs, labels FROM i JOIN l USING (basename, r, w) WHERE n = {T}"""
    return {"bpe_examples": learned + pieces + ids.rstrip().rstrip(",") + examples,
            "load_merges": f"{learned} {merges}",
            "bpe_pieces": f"{learned}{pieces} SELECT array_to_string({parts}, '') AS bc, array_to_string({parts}, ' ') AS pieces FROM fin",
            "bpe_token_counts": learned + pieces + counts}


def vocab_cte(max_size: int | None) -> str:
    lim = f"ORDER BY cnt DESC, first LIMIT {max_size}" if max_size else ""
    return SPECIALS + f""",
topk AS (SELECT sym, cnt, first FROM counts {lim}),
kept AS (SELECT sym, cnt, first FROM topk WHERE sym NOT IN (SELECT sym FROM specials)),
vocab AS (SELECT CAST(id AS BIGINT) AS id, sym, CAST(NULL AS BIGINT) AS cnt FROM specials
          UNION ALL
          SELECT CAST(row_number() OVER (ORDER BY cnt DESC, first) - 1 + 2 AS BIGINT) AS id, sym, cnt FROM kept)"""


STREAM = tokens_cte("tok", marks=True) + """,
stream AS (SELECT t.doc_id, t.line_no, t.pos, t.p, COALESCE(v.id, 1) AS id
           FROM tok t LEFT JOIN vocab v ON t.sym = v.sym)"""

CORE = LINES + "," + COUNTS + "," + vocab_cte(CFG.max_size) + "," + STREAM


def windows_sql(Bq: int, Tq: int, fixed: bool) -> str:
    keep = f"WHERE i.n = {Tq}" if fixed else ""
    return f"""WITH {CORE},
params AS (SELECT count(*) // {Bq} AS S FROM stream),
grid AS (SELECT p // S AS r, p % S AS c, id, S FROM stream, params WHERE p < {Bq} * S),
win_in AS (SELECT r, c // {Tq} AS w, count(*) AS n, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY c) AS inputs
           FROM grid WHERE c < S - 1 GROUP BY r, w),
win_lb AS (SELECT r, (c - 1) // {Tq} AS w, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY c) AS labels
           FROM grid WHERE c >= 1 GROUP BY r, w)
SELECT i.w, i.r, i.w * {Bq} + i.r AS sample_id, i.inputs, l.labels
FROM win_in i JOIN win_lb l ON i.r = l.r AND i.w = l.w {keep}"""


BINS = f"""
vsize AS (SELECT count(*) AS V FROM vocab),
tbins AS (SELECT * FROM (VALUES (0, {TAIL_CUTS[0]}, {TAIL_CUTS[1]}), (1, {TAIL_CUTS[1]}, {TAIL_CUTS[2]})) t(bin, lo, hi)
          UNION ALL SELECT 2, {TAIL_CUTS[2]}, V FROM vsize),
allbins AS (SELECT 0 AS bin, 0 AS lo, {TAIL_CUTS[0]} AS hi UNION ALL SELECT bin + 1, lo, hi FROM tbins),
bparams AS (SELECT count(*) // {B // C} // {T} AS nb FROM stream),
btok AS (SELECT p, id, (p % (nb * {T})) // {T} AS j FROM stream, bparams WHERE p < {B // C} * nb * {T}),
bgrid AS (SELECT unnest(range(0, nb)) AS j FROM bparams),
bcnt AS (SELECT j, bin, count(*) AS n FROM btok JOIN tbins ON id >= lo AND id < hi GROUP BY j, bin),
bshare AS (SELECT g.j, t.bin, COALESCE(c.n, 0) AS n, COALESCE(c.n, 0) / {B // C * T} AS share
           FROM bgrid g CROSS JOIN tbins t LEFT JOIN bcnt c ON c.j = g.j AND c.bin = t.bin),
braw AS (SELECT bin, {T * (B // C)} * (avg(share) + 2.5 * stddev_pop(share)) AS raw FROM bshare GROUP BY bin),
bx AS (SELECT bin, raw, CAST(ceil(round(raw, 9)) AS BIGINT) AS x FROM braw),
bsizes AS (SELECT bin, raw, greatest(8, 8 * ((x + 4) // 8)) AS size FROM bx)"""

FIXED = f"""
fparams AS (SELECT count(*) // {B} AS S FROM stream),
fgrid AS (SELECT p // S AS r, p % S AS c, id, S FROM stream, fparams WHERE p < {B} * S),
tin AS (SELECT r, c // {T} AS w, c % {T} AS i, id FROM fgrid WHERE c < S - 1 AND c // {T} < (S - 1) // {T}),
tlb AS (SELECT r, (c - 1) // {T} AS w, (c - 1) % {T} AS i, id FROM fgrid WHERE c >= 1 AND (c - 1) // {T} < (S - 1) // {T}),
tslots AS (
  SELECT 'inp' AS side, w, r, i, id, bin,
         row_number() OVER (PARTITION BY w, r // {B // C}, bin ORDER BY r, i) - 1 AS slot
  FROM tin JOIN tbins ON id >= lo AND id < hi
  UNION ALL
  SELECT 'tgt' AS side, w, r, i, id, bin,
         row_number() OVER (PARTITION BY w, r // {B // C}, bin ORDER BY r, i) - 1 AS slot
  FROM tlb JOIN tbins ON id >= lo AND id < hi),
bkept AS (SELECT s.*, b.size FROM tslots s JOIN bsizes b ON s.bin = b.bin WHERE s.slot < b.size),
allw AS (SELECT DISTINCT w, r FROM tin),
combos AS (SELECT w, r, side, bin FROM allw, (VALUES ('inp'), ('tgt')) s(side), tbins)"""


def fixed_q(select: str) -> str:
    return f"WITH {CORE}, {BINS}, {FIXED} {select}"


def shard_lines() -> str:
    return f"""{LINES},
shards AS (SELECT shard, row_number() OVER (ORDER BY shard) - 1 AS shard_no FROM (SELECT DISTINCT source AS shard FROM documents)),
ssplit AS (SELECT shard, shard_no, CASE WHEN shard_no = 0 THEN 'valid' WHEN shard_no = 1 THEN 'test' ELSE 'train' END AS split FROM shards),
slines AS (SELECT l.*, s.split, s.shard_no FROM lines l JOIN ssplit s USING (shard))"""


# RE2 has no look-ahead: the whitespace-run-before-non-space alternative is dropped (the tables
# hold no double spaces, so the two patterns agree on them).
RE2_PAT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\pL+| ?\pN+| ?[^\s\pL\pN]+|\s+""".replace("'", "''")
BYTE_MAP = "MAP {" + ", ".join("'%02X': '%s'" % (b, ch.replace("'", "''")) for b, ch in byte_char_table()) + "}"


def split_core() -> str:
    """Shard-split corpus: vocabulary from train (top max_size), ``stream`` = the valid split,
    ``tstream`` = the train split (ids only)."""
    return f"""{shard_lines()},
trl AS (SELECT * FROM slines WHERE split = 'train'),
{tokens_cte("ctok", marks=True, lines="trl").lstrip()},
counts AS (SELECT sym, count(*) AS cnt, min(p) AS first FROM ctok WHERE pos < nsym - 1 GROUP BY sym),
{vocab_cte(CFG.max_size).lstrip()},
vl AS (SELECT * FROM slines WHERE split = 'valid'),
{tokens_cte("tok", marks=True, lines="vl").lstrip()},
stream AS (SELECT t.doc_id, t.line_no, t.pos, t.p, COALESCE(v.id, 1) AS id FROM tok t LEFT JOIN vocab v ON t.sym = v.sym),
{tokens_cte("ttok", marks=True, lines="trl").lstrip()},
tstream AS (SELECT COALESCE(v.id, 1) AS id FROM ttok t LEFT JOIN vocab v ON t.sym = v.sym)"""


SPLIT_CORE = split_core()

MODEL = f"""
vsz AS (SELECT count(*) AS V FROM vocab),
tcnt AS (SELECT id, count(*) AS cnt FROM tstream GROUP BY id),
m0 AS (SELECT v.id, COALESCE(t.cnt, 0) AS cnt,
          CASE WHEN v.id < {TAIL_CUTS[0]} THEN 0 WHEN v.id < {TAIL_CUTS[1]} THEN 1 WHEN v.id < {TAIL_CUTS[2]} THEN 2 ELSE 3 END AS bin
       FROM vocab v LEFT JOIN tcnt t ON v.id = t.id),
m1 AS (SELECT *, CASE WHEN bin = 0 THEN id ELSE {TAIL_CUTS[0]} + bin - 1 END AS slot FROM m0),
m2 AS (SELECT *, sum(cnt) OVER (PARTITION BY slot) AS slot_cnt, sum(cnt) OVER (PARTITION BY bin) AS bin_cnt,
              sum(cnt) OVER () AS NN FROM m1),
model AS (SELECT id, -(ln((slot_cnt + 1) / (NN + {TAIL_CUTS[0] + 3})) +
   CASE WHEN bin > 0 THEN ln((cnt + 1) / (bin_cnt + CASE bin WHEN 1 THEN {TAIL_CUTS[1] - TAIL_CUTS[0]}
        WHEN 2 THEN {TAIL_CUTS[2] - TAIL_CUTS[1]} ELSE V - {TAIL_CUTS[2]} END)) ELSE 0 END) AS loss FROM m2, vsz)"""


def shard_sql() -> dict[str, str]:
    """Sharded sets token by token: each (shard, shuffle) is a stream, bin counters restart in each (file, window, core)."""
    marks = f"list_concat(['<S>'], {words()}, ['<S>'])"
    core = f"""{shard_lines()},
trl AS (SELECT * FROM slines WHERE split = 'train'),
{tokens_cte("ctok", marks=True, lines="trl").lstrip()},
counts AS (SELECT sym, count(*) AS cnt, min(p) AS first FROM ctok WHERE pos < nsym - 1 GROUP BY sym),
{vocab_cte(SHARD_CFG.max_size).lstrip().replace("<eos>", "<S>").replace("<unk>", "<UNK>")},
sent AS (SELECT shard, shard_no, split, doc_id, line_no, {marks} AS symbols, shuffle,
           CASE WHEN split = 'train' THEN printf('train-%03d-%02d', shard_no, shuffle) ELSE split END || '.bsz-{B}.tlen-{T}.core-{C}' AS basename,
           CASE WHEN split = 'train' THEN md5('{SEED}:' || shard || ':' || shuffle || ':' || doc_id || ':' || line_no) ELSE '' END AS ord
         FROM slines, (SELECT unnest(range(0, {SHUFFLES})) AS shuffle) WHERE split = 'train' OR (split = 'valid' AND shuffle = 0)),
st0 AS (SELECT *, unnest(symbols) AS sym, unnest(range(0, len(symbols))) AS pos FROM sent),
st1 AS (SELECT split, basename, sym, row_number() OVER (PARTITION BY basename ORDER BY ord, doc_id, line_no, pos) - 1 AS p, count(*) OVER (PARTITION BY basename) AS n FROM st0),
every AS (SELECT split, basename, p, n // {B} AS S, coalesce(v.id, 1) AS id FROM st1 LEFT JOIN vocab v USING (sym)),
stream AS (SELECT p, id FROM every WHERE split = 'valid'), {BINS},
g AS (SELECT split, basename, p // S AS r, p % S AS c, id, S FROM every WHERE p < {B} * S),
tok AS (SELECT 'inp' AS side, split, basename, r, c // {T} AS w, c % {T} AS i, id FROM g WHERE c < S - 1 AND c // {T} < (S - 1) // {T}
        UNION ALL SELECT 'tgt', split, basename, r, (c - 1) // {T}, (c - 1) % {T}, id FROM g WHERE c >= 1 AND (c - 1) // {T} < (S - 1) // {T})"""
    head = (f"CASE WHEN id < {TAIL_CUTS[0]} THEN id WHEN id < {TAIL_CUTS[1]} THEN {TAIL_CUTS[0]} WHEN id < {TAIL_CUTS[2]} THEN {TAIL_CUTS[0] + 1} ELSE {TAIL_CUTS[0] + 2} END")
    out = {}
    out["shard_examples"] = f"""WITH {core},
slot AS (SELECT t.*, bin, size, row_number() OVER (PARTITION BY basename, side, w, r // {B // C}, bin ORDER BY r, i) - 1 AS slot FROM tok t JOIN tbins ON id >= lo AND id < hi JOIN bsizes USING (bin)),
tup AS (SELECT basename, side, w, r, bin, string_agg(i || ' ' || slot, ' ' ORDER BY i) AS tup FROM slot WHERE slot < size GROUP BY ALL),
ex AS (SELECT basename, w, r, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i) FILTER (side = 'inp') AS inputs, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i) FILTER (side = 'tgt') AS labels,
         string_agg(CAST({head} AS VARCHAR), ' ' ORDER BY i) FILTER (side = 'tgt') AS head_labels FROM tok WHERE split = 'train' GROUP BY ALL),
lists AS (SELECT e.basename, e.w, e.r, s.side, string_agg(coalesce(t.tup, ''), '|' ORDER BY tb.bin) AS tups
          FROM ex e CROSS JOIN (VALUES ('inp'), ('tgt')) s(side) CROSS JOIN tbins tb
          LEFT JOIN tup t ON t.basename = e.basename AND t.w = e.w AND t.r = e.r AND t.side = s.side AND t.bin = tb.bin GROUP BY ALL)
SELECT e.basename, e.w * {B} + e.r AS sample_id, e.inputs, e.labels, e.head_labels, a.tups AS inp_tup, b.tups AS tgt_tup
FROM ex e JOIN lists a ON a.basename = e.basename AND a.w = e.w AND a.r = e.r AND a.side = 'inp' JOIN lists b ON b.basename = e.basename AND b.w = e.w AND b.r = e.r AND b.side = 'tgt'"""
    out["load_record_info"] = f"""WITH {core},
f AS (SELECT split, basename, max(CASE WHEN S <= 1 THEN 0 ELSE (S - 1) // {T} END) AS W FROM every GROUP BY ALL),
h AS (SELECT basename, count(DISTINCT (w, r)) AS examples, sum(id) AS sums FROM tok WHERE side = 'inp' GROUP BY basename)
SELECT f.split, f.basename, (SELECT string_agg(CAST(size AS VARCHAR), ' ' ORDER BY bin) FROM bsizes) AS bin_sizes,
  CAST(sum(f.W) OVER (PARTITION BY f.split) AS BIGINT) AS num_batch, coalesce(h.examples, 0) AS examples, CAST(coalesce(h.sums, 0) AS BIGINT) AS sum_inputs
FROM f LEFT JOIN h USING (basename)"""
    return out


def entry_sql() -> str:
    return windows_sql(ENTRY_B, ENTRY_T, fixed=False)


def all_sql() -> dict[str, str]:
    q = {}
    q["read_lines"] = f"WITH {LINES} SELECT shard, doc_id, line_no, line, has_newline FROM lines"
    q["tokenize_words"] = f"""WITH {LINES}
SELECT doc_id, line_no, CAST(len({words(True)}) AS BIGINT) AS n_words, array_to_string({words(True)}, ' ') AS words FROM lines"""
    q["symbol_counts"] = f"WITH {LINES}, {COUNTS} SELECT sym, cnt, first_key AS first FROM counts"
    q["vocab_ids"] = f"WITH {LINES}, {COUNTS}, {vocab_cte(None)} SELECT id, sym FROM vocab"
    q["vocab_top_k"] = f"WITH {LINES}, {COUNTS}, {vocab_cte(CFG.max_size)} SELECT id, sym, COALESCE(cnt, 0) AS cnt FROM vocab"
    q["corpus_cache"] = q["vocab_top_k"]
    q["token_positions"] = f"WITH {CORE} SELECT p, id FROM stream"
    q["windows_ragged"] = windows_sql(B, T, fixed=False)
    q["windows_fixed"] = windows_sql(B, T, fixed=True)
    q["bin_join"] = f"""WITH {CORE}, {BINS}
SELECT p, id, CAST(bin AS BIGINT) AS bin FROM stream JOIN allbins ON id >= lo AND id < hi"""
    q["bin_counts"] = f"WITH {CORE}, {BINS} SELECT j, CAST(bin AS BIGINT) AS bin, CAST(n AS BIGINT) AS n, round(share, 6) AS share FROM bshare"
    q["bin_sizes"] = f"WITH {CORE}, {BINS} SELECT CAST(bin AS BIGINT) AS bin, round(raw, 3) AS raw, CAST(size AS BIGINT) AS size FROM bsizes"
    q["num_batches"] = f"""WITH {shard_lines()},
n AS (SELECT split, CAST(sum(len({words()}) + 1) AS BIGINT) AS n_tokens FROM slines GROUP BY split)
SELECT split, n_tokens,
  CAST(CASE WHEN n_tokens // {B} <= 1 THEN 0 ELSE ceil((n_tokens // {B} - 1) / {T}) END AS BIGINT) AS num_batch_ragged,
  CAST(CASE WHEN n_tokens // {B} <= 1 THEN 0 ELSE (n_tokens // {B} - 1) // {T} END AS BIGINT) AS num_batch_fixed FROM n"""
    mask = f"CASE WHEN id >= 0 AND id < {TAIL_CUTS[0]} THEN '1' ELSE '0' END"
    q["bin_masks"] = fixed_q(f"""SELECT a.w * {B} + a.r AS sample_id, a.m AS inp_mask, b.m AS tgt_mask FROM
 (SELECT w, r, string_agg({mask}, ' ' ORDER BY i) AS m FROM tin GROUP BY w, r) a
 JOIN (SELECT w, r, string_agg({mask}, ' ' ORDER BY i) AS m FROM tlb GROUP BY w, r) b USING (w, r)""")
    head = (f"CASE WHEN id >= {TAIL_CUTS[0]} AND id < {TAIL_CUTS[1]} THEN {TAIL_CUTS[0]} "
            f"WHEN id >= {TAIL_CUTS[1]} AND id < {TAIL_CUTS[2]} THEN {TAIL_CUTS[0] + 1} "
            f"WHEN id >= {TAIL_CUTS[2]} AND id < (SELECT V FROM vsize) THEN {TAIL_CUTS[0] + 2} ELSE id END")
    q["head_labels"] = fixed_q(f"SELECT w * {B} + r AS sample_id, string_agg(CAST({head} AS VARCHAR), ' ' ORDER BY i) AS head_labels FROM tlb GROUP BY w, r")
    agg = """agg AS (SELECT w, r, side, bin, count(*) AS cnt, string_agg(i || ' ' || slot, ' ' ORDER BY i) AS tup,
                sum(i * size + slot) AS weighted FROM bkept GROUP BY w, r, side, bin)"""
    q["perm_tuples"] = fixed_q(f""", {agg}
SELECT c.w * {B} + c.r AS sample_id, c.side, CAST(c.bin AS BIGINT) AS bin, CAST(COALESCE(a.cnt, 0) AS BIGINT) AS cnt, COALESCE(a.tup, '') AS tup
FROM combos c LEFT JOIN agg a USING (w, r, side, bin)""".replace("WITH", "WITH", 1))
    q["bin_slots"] = fixed_q(f"SELECT w * {B} + r AS sample_id, side, CAST(bin AS BIGINT) AS bin, CAST(i AS BIGINT) AS pos, CAST(slot AS BIGINT) AS slot FROM bkept")
    q["dense_perm_sums"] = fixed_q(f""", {agg}
SELECT c.w * {B} + c.r AS sample_id, c.side, CAST(c.bin AS BIGINT) AS bin, CAST(COALESCE(a.cnt, 0) AS BIGINT) AS ones,
       CAST(COALESCE(a.weighted, 0) AS BIGINT) AS weighted
FROM combos c LEFT JOIN agg a USING (w, r, side, bin)""")
    ragged = windows_sql(B, T, fixed=False)
    fixed = windows_sql(B, T, fixed=True)
    q["examples_roundtrip"] = ragged.replace("SELECT i.w, i.r, i.w", "SELECT i.w * " + str(B) + " + i.r AS sample_id, i.w, i.r, i.w", 1).replace(
        f"i.w * {B} + i.r AS sample_id, i.inputs", "i.inputs", 1)
    q["read_examples"] = fixed_q(f"""SELECT a.w * {B} + a.r AS sample_id, a.inputs, b.labels, b.head_labels, a.inp_mask FROM
 (SELECT w, r, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i) AS inputs, string_agg({mask}, ' ' ORDER BY i) AS inp_mask FROM tin GROUP BY w, r) a
 JOIN (SELECT w, r, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i) AS labels,
              string_agg(CAST({head} AS VARCHAR), ' ' ORDER BY i) AS head_labels FROM tlb GROUP BY w, r) b USING (w, r)""")
    q["record_info"] = fixed_q(f"""SELECT 'train' AS split, 'train.bsz-{B}.tlen-{T}.core-{C}' AS filenames,
 (SELECT string_agg(CAST(size AS VARCHAR), ' ' ORDER BY bin) FROM bsizes) AS bin_sizes,
 (SELECT CAST(count(DISTINCT w) AS BIGINT) FROM tin) AS num_batch""")
    q["example_files"] = f"""WITH {shard_lines()},
n AS (SELECT split, CASE WHEN split = 'train' THEN printf('train-%03d-%02d', shard_no, 0) ELSE split END AS basename,
             CAST(sum(len({words()}) + 1) AS BIGINT) AS n_tokens FROM slines GROUP BY ALL)
SELECT split, basename, basename || '.bsz-{B}.tlen-{T}.core-{C}' AS file_name, n_tokens,
  CAST(CASE WHEN n_tokens // {B} <= 1 THEN 0 ELSE (n_tokens // {B} - 1) // {T} END AS BIGINT) AS num_batch FROM n"""
    q["corpus_info"] = f"""WITH {LINES}, {COUNTS}, {vocab_cte(CFG.max_size)}
SELECT CAST(count(*) AS BIGINT) AS vocab_size, '0 {' '.join(map(str, TAIL_CUTS))} ' || count(*) AS cutoffs, 'wt103' AS dataset FROM vocab"""
    fw = f"SELECT w * {B} + r AS sample_id FROM ({fixed})"
    q["replica_slots"] = f"""SELECT sample_id, sample_id // {B // C} AS chunk, (sample_id // {B // C}) % {C} AS replica,
 (sample_id // {B // C}) // {C} AS step FROM ({fw})"""
    q["full_batches"] = f"""SELECT sample_id, chunk FROM (SELECT sample_id, sample_id // 5 AS chunk, count(*) OVER (PARTITION BY sample_id // 5) AS n FROM ({fw})) WHERE n = 5"""
    q["host_ranges"] = f"""WITH f AS ({fw}), k AS (SELECT (count(*) // {B} // 3) * {C} * {B // C} AS k FROM f)
SELECT sample_id, sample_id // k AS host FROM f, k WHERE sample_id < 3 * k"""
    q["pad_last_batch"] = f"""WITH e AS ({ragged}), bt AS (SELECT DISTINCT sample_id // 10 AS batch FROM e),
sl AS (SELECT batch, unnest(range(0, 10)) AS slot FROM bt)
SELECT sl.batch, sl.slot, e.sample_id IS NULL AS is_padding,
  COALESCE(e.inputs, array_to_string(list_transform(range(0, {T}), lambda x: 0), ' ')) AS inputs
FROM sl LEFT JOIN e ON e.sample_id // 10 = sl.batch AND e.sample_id % 10 = sl.slot"""
    q["file_order"] = f"""WITH {shard_lines().split('slines AS')[0].rstrip().rstrip(',')},
files AS (SELECT printf('train-%03d-%02d', shard_no, 0) AS file FROM ssplit WHERE split = 'train'),
ep AS (SELECT unnest(range(0, 3)) AS epoch)
SELECT CAST(epoch AS BIGINT) AS epoch, row_number() OVER (PARTITION BY epoch ORDER BY md5('123456:' || epoch || ':' || file), file) - 1 AS rank, file
FROM files, ep"""
    q["shard_list"] = "SELECT shard, row_number() OVER (ORDER BY shard) - 1 AS shard_no FROM (SELECT DISTINCT source AS shard FROM documents)"
    q["split_by_shard"] = f"WITH {shard_lines()} SELECT shard, shard_no, split FROM ssplit"
    q["split_named"] = f"""WITH {shard_lines()},
mp AS (SELECT shard, unnest(CASE WHEN shard_no = 0 THEN ['valid', 'test'] ELSE ['train'] END) AS split FROM shards)
SELECT mp.split, l.doc_id, l.line_no FROM lines l JOIN mp USING (shard)"""
    n = 100000
    q["split_tail_chars"] = f"""WITH d AS (SELECT doc_id, text || chr(10) AS raw, length(text || chr(10)) AS len FROM documents),
o AS (SELECT *, sum(len) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - len AS start FROM d),
tot AS (SELECT sum(len) AS L FROM d),
parts AS (SELECT 'train' AS split, 0 AS lo, greatest(L - {2 * n}, 0) AS hi FROM tot
          UNION ALL SELECT 'valid', greatest(L - {2 * n}, 0), greatest(L - {n}, 0) FROM tot
          UNION ALL SELECT 'test', greatest(L - {n}, 0), L FROM tot),
pc AS (SELECT p.split, o.doc_id, greatest(o.start, p.lo) AS ps, least(o.start + o.len, p.hi) AS pe, o.start, o.raw
       FROM o JOIN parts p ON o.start < p.hi AND o.start + o.len > p.lo),
pcs AS (SELECT split, doc_id, ps AS piece_start, pe - ps AS piece_len,
               substring(raw, CAST(ps - start + 1 AS BIGINT), CAST(pe - ps AS BIGINT)) AS raw FROM pc),
lt AS (SELECT *, length(regexp_extract(raw, '^\\s*')) AS lead, length(regexp_extract(raw, '\\s*$')) AS trail FROM pcs),
bd AS (SELECT split, min(CASE WHEN lead < piece_len THEN piece_start + lead END) AS s_lo,
              max(CASE WHEN lead < piece_len THEN piece_start + piece_len - trail END) AS s_hi FROM lt GROUP BY split),
tx AS (SELECT lt.split, doc_id, piece_start, piece_len, raw,
              CASE WHEN least(piece_start + piece_len, s_hi) > greatest(piece_start, s_lo)
                   THEN substring(raw, CAST(greatest(piece_start, s_lo) - piece_start + 1 AS BIGINT),
                                  CAST(least(piece_start + piece_len, s_hi) - greatest(piece_start, s_lo) AS BIGINT))
                   ELSE '' END AS text
       FROM lt JOIN bd USING (split))
SELECT split, doc_id, CAST(piece_start AS BIGINT) AS piece_start, CAST(piece_len AS BIGINT) AS piece_len, md5(raw) AS raw_md5, md5(text) AS text_md5,
  md5(array_to_string(list_transform(regexp_extract_all(text, '(?s).'), lambda c: CASE WHEN c = ' ' THEN '_' ELSE c END), ' ')) AS spaced_md5
FROM tx"""
    q["tokenize_delim"] = f"""WITH {LINES}
SELECT doc_id, line_no, CAST(len(string_split(trim(line), ',')) AS BIGINT) AS n, array_to_string(string_split(trim(line), ','), '|') AS symbols FROM lines"""
    q["tokenize_chars"] = f"""WITH {LINES}
SELECT doc_id, line_no, CAST(len(regexp_extract_all(lower(trim(line)), '(?s).')) AS BIGINT) AS n,
       array_to_string(regexp_extract_all(lower(trim(line)), '(?s).'), ' ') AS symbols FROM lines"""
    q["add_marks"] = f"""WITH {LINES}
SELECT doc_id, line_no, array_to_string(list_concat(['<S>'], {words()}, ['<S>']), ' ') AS symbols FROM lines"""
    q["space_chars"] = f"""WITH {LINES}
SELECT doc_id, line_no, array_to_string(list_transform(regexp_extract_all(line, '(?s).'), lambda c: CASE WHEN c = ' ' THEN '_' ELSE c END), ' ') AS spaced FROM lines"""
    q["vocab_from_file"] = f"""WITH {LINES}, {COUNTS},
body AS (SELECT row_number() OVER (ORDER BY cnt DESC, first) - 1 + 3 AS line_no, lower(sym) || ' ' || cnt AS line FROM counts),
vf AS (SELECT * FROM (VALUES (0, '<S>'), (1, '</S>'), (2, '<UNK>')) t(line_no, line) UNION ALL SELECT * FROM body),
fs AS (SELECT string_split(line, ' ')[1] AS sym, min(line_no) AS ln FROM vf GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY ln) - 1 AS BIGINT) AS id, sym FROM fs"""
    q["vocab_min_freq"] = f"""WITH {LINES}, {COUNTS}, {vocab_cte(None).replace("FROM counts ", "FROM counts WHERE cnt >= 3 ")}
SELECT id, sym FROM vocab"""
    q["vocab_size"] = f"WITH {CORE} SELECT (SELECT count(*) FROM vocab) AS vocab_size, (SELECT count(*) FROM counts) AS unique_tokens"
    q["oov_report"] = f"""WITH {CORE}
SELECT sym, count(*) AS cnt, CAST(min({KEY}) AS VARCHAR) AS first FROM tok WHERE sym NOT IN (SELECT sym FROM vocab) GROUP BY sym"""
    q["encode_unk"] = f"WITH {CORE} SELECT doc_id, line_no, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids FROM stream GROUP BY doc_id, line_no"
    q["decode_words"] = f"""WITH {CORE}
SELECT s.doc_id, s.line_no, string_agg(v.sym, ' ' ORDER BY s.pos) AS text FROM stream s JOIN vocab v ON s.id = v.id
WHERE s.id <> 0 GROUP BY s.doc_id, s.line_no"""
    q["counts_all_splits"] = f"""WITH {shard_lines()},
al AS (SELECT *, CASE split WHEN 'train' THEN 0 WHEN 'valid' THEN 1 ELSE 2 END AS split_ord FROM slines),
{tokens_cte("atok", marks=True, lines="al", part="split_ord").lstrip()}
SELECT sym, count(*) AS cnt, CAST(min(split_ord * CAST(1000000000000000000000000000000000000 AS HUGEINT) + {KEY}) AS VARCHAR) AS first FROM atok WHERE pos < nsym - 1 GROUP BY sym"""
    q["sentence_counts"] = f"""WITH cs AS (SELECT conv_id, turn, {words(col="text")} AS symbols FROM conversations),
c0 AS (SELECT conv_id, turn, unnest(symbols) AS sym, unnest(range(0, len(symbols))) AS pos FROM cs),
c1 AS (SELECT sym, conv_id AS doc_id, turn AS line_no, pos FROM c0)
SELECT sym, count(*) AS cnt, CAST(min({KEY}) AS VARCHAR) AS first FROM c1 GROUP BY sym"""
    q["batch_grid"] = f"""WITH {CORE}, params AS (SELECT count(*) // {B} AS S FROM stream)
SELECT p, p // S AS r, p % S AS c FROM stream, params WHERE p < {B} * S"""
    q["next_token"] = f"""WITH {CORE}, params AS (SELECT count(*) // {B} AS S FROM stream),
g AS (SELECT p // S AS r, p % S AS c, id, S FROM stream, params WHERE p < {B} * S),
l AS (SELECT r, c, id, lead(id) OVER (PARTITION BY r ORDER BY c) AS next_id, S FROM g)
SELECT r, c, id, next_id FROM l WHERE c < S - 1"""
    q["rotated_passes"] = f"""WITH {CORE}, nn AS (SELECT count(*) AS N FROM stream),
ps AS (SELECT 0 AS pass, N // 3 AS st FROM nn UNION ALL SELECT 1, (2 * N) // 3 FROM nn)
SELECT CAST(pass AS BIGINT) AS pass, pass * N + (((p - st) % N) + N) % N AS p, id FROM stream, ps, nn"""
    shuf = f"""{shard_lines()},
tl AS (SELECT * FROM slines WHERE split = 'train'),
sh AS (SELECT tl.*, s AS shuffle FROM tl, (SELECT unnest(range(0, 2)) AS s)),
rk AS (SELECT *, row_number() OVER (PARTITION BY shard, shuffle
         ORDER BY md5('123456:' || shard || ':' || shuffle || ':' || doc_id || ':' || line_no)) - 1 AS rank FROM sh)"""
    q["shuffled_sentences"] = f"WITH {shuf} SELECT shard, CAST(shuffle AS BIGINT) AS shuffle, rank, doc_id, line_no FROM rk"
    q["shard_streams"] = f"""WITH {shuf},
nn AS (SELECT *, CAST(len({words()}) + 2 AS BIGINT) AS n FROM rk)
SELECT shard, CAST(shuffle AS BIGINT) AS shuffle, doc_id, line_no,
  CAST(sum(n) OVER (PARTITION BY shard, shuffle ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS BIGINT) AS start_p, n FROM nn"""
    q.update(shard_sql())
    q["rotated_examples"] = f"""WITH {CORE}, nn AS (SELECT count(*) AS N FROM stream),
ps AS (SELECT 0 AS pass, N // 3 AS st FROM nn UNION ALL SELECT 1, 0 FROM nn UNION ALL SELECT 2, (2 * N) // 3 FROM nn),
rot AS (SELECT pass * N + (((p - st) % N) + N) % N AS p, id FROM stream, ps, nn),
params AS (SELECT count(*) // {B} AS S FROM rot),
grid AS (SELECT p // S AS r, p % S AS c, id, S FROM rot, params WHERE p < {B} * S),
i AS (SELECT r, c // {T} AS w, count(*) AS n, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY c) AS inputs FROM grid WHERE c < S - 1 GROUP BY r, w),
l AS (SELECT r, (c - 1) // {T} AS w, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY c) AS labels FROM grid WHERE c >= 1 GROUP BY r, w)
SELECT w * {B} + r AS sample_id, w, r, inputs, labels FROM i JOIN l USING (r, w) WHERE n = {T}"""
    bl = f"""{LINES},
bl AS (SELECT doc_id, line_no, CASE WHEN has_newline THEN line || chr(10) ELSE line END AS text FROM lines),
bt0 AS (SELECT doc_id, line_no, regexp_extract_all(text, '{RE2_PAT}') AS toks FROM bl),
bt AS (SELECT doc_id, line_no, unnest(toks) AS token, unnest(range(0, len(toks))) AS tok_no FROM bt0)"""
    q["bpe_pretokens"] = f"WITH {bl} SELECT doc_id, line_no, tok_no, token FROM bt"
    q["byte_chars"] = f"""WITH {bl}, bm AS (SELECT {BYTE_MAP} AS m)
SELECT doc_id, line_no, tok_no,
  array_to_string(list_transform(regexp_extract_all(hex(encode(token)), '..'), lambda h: m[h]), '') AS bc FROM bt, bm"""
    q.update(bpe_sql(bl))
    q["bpe_roundtrip"] = f"""WITH {LINES}
SELECT doc_id, line_no, md5(CASE WHEN has_newline THEN line || chr(10) ELSE line END) AS text_md5 FROM lines"""
    ML = f"""WITH {SPLIT_CORE}, {MODEL}, {BINS},
vparams AS (SELECT count(*) // {B} AS S FROM stream),
lab AS (SELECT (p % S - 1) // {T} AS step, p // S AS rw, m.loss FROM stream s JOIN model m USING (id), vparams
        WHERE p < {B} * S AND p % S >= 1),
sm AS (SELECT step, count(*) AS n, avg(loss) AS loss FROM lab GROUP BY step)"""
    q["count_model_loss"] = f"WITH {SPLIT_CORE}, {MODEL} SELECT p, id, round(loss, 6) AS loss FROM stream JOIN model USING (id)"
    q["loss_mean"] = f"{ML} SELECT step, n, round(loss, 6) AS loss FROM sm"
    q["ppl_step_mean"] = f"{ML} SELECT round(avg(exp(loss)), 6) AS perplexity, round(avg(loss) / ln(2), 6) AS bpc, count(*) AS steps FROM sm"
    q["ppl_token_weighted"] = f"""{ML}, tw AS (SELECT sum(loss * n) / sum(n) AS loss FROM sm)
SELECT round(loss, 6) AS loss, round(exp(loss), 6) AS perplexity, round(loss / ln(2), 6) AS bpc FROM tw"""
    q["replica_mean"] = f"""{ML}, pc AS (SELECT step, rw // {B // C} AS core, avg(loss) AS l FROM lab GROUP BY ALL)
SELECT step, round(sum(l) / {C}, 6) AS loss FROM pc GROUP BY step"""
    q["loss_capacity_mean"] = f"""WITH {SPLIT_CORE}, {MODEL}, {BINS}, {FIXED},
capk AS (SELECT l.w, l.id, (l.id < {TAIL_CUTS[0]}) OR (k.slot IS NOT NULL) AS kept FROM tlb l
         LEFT JOIN bkept k ON k.side = 'tgt' AND k.w = l.w AND k.r = l.r AND k.i = l.i)
SELECT w AS step, CAST(sum(CAST(kept AS INT)) AS BIGINT) AS n_kept,
  round(sum(CASE WHEN kept THEN loss ELSE 0 END) / sum(CAST(kept AS INT)), 6) AS loss FROM capk JOIN model USING (id) GROUP BY w"""
    q["loop_mean_loss"] = "SELECT event_id // 100 AS loop, round(avg(value), 6) AS mean_loss, count(*) AS steps FROM events GROUP BY 1"
    q["throughput"] = f"""WITH sp AS (SELECT event_id // 100 AS span, max(event_id) - min(event_id) AS steps,
  epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM events GROUP BY 1),
r AS (SELECT span, CASE WHEN us > 0 THEN steps / (us / 1e6) END AS sps FROM sp)
SELECT span, round(sps, 6) AS steps_per_sec, round(sps * {B}, 6) AS examples_per_sec FROM r"""
    q["lr_by_step"] = """SELECT event_id AS step, round(1e6 * CASE WHEN event_id < 1000 THEN event_id / 1000 * 2.5e-4
  ELSE 2.5e-4 * ((1 - 0.004) * 0.5 * (1 + cos(pi() * least(event_id - 1000, 9000) / 9000)) + 0.004) END, 6) AS lr_e6 FROM events"""
    q["eval_capped"] = "SELECT event_id AS step, round(value, 6) AS loss FROM events WHERE event_id < least((SELECT count(*) FROM events), 500)"
    q["eval_ratio"] = "SELECT event_id AS step, round(value, 6) AS loss FROM events WHERE event_id < (SELECT count(*) FROM events) // 4"
    el = """el AS (SELECT event_id AS step FROM events WHERE event_id >= 1000 AND event_id % 50 = 0
  AND event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'click'))"""
    q["eligible_checkpoints"] = f"WITH {el} SELECT step FROM el"
    q["best_checkpoint"] = f"""WITH {el} SELECT step, round(exp(value / 10), 6) AS perplexity FROM el JOIN events ON el.step = events.event_id
ORDER BY exp(value / 10), step LIMIT 1"""
    q["last_checkpoints"] = f"""WITH {el}, l5 AS (SELECT step FROM el ORDER BY step DESC LIMIT 5)
SELECT step, row_number() OVER (ORDER BY step) - 1 AS ord FROM l5"""
    q["average_params"] = """WITH pr AS (SELECT vec_id % 5 AS ckpt, printf('v%05d', vec_id // 5) AS name, embedding FROM embeddings),
ck AS (SELECT DISTINCT ckpt FROM pr ORDER BY ckpt DESC LIMIT 3),
ex AS (SELECT name, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS pos FROM pr WHERE ckpt IN (SELECT ckpt FROM ck))
SELECT name, CAST(pos AS BIGINT) AS pos, round(sum(CAST(v AS DOUBLE)) / 3, 6) AS value FROM ex GROUP BY name, pos"""
    grid = f"""WITH {CORE}, params AS (SELECT count(*) // {B} AS S FROM stream),
grid AS (SELECT p // S AS r, p % S AS c, id, S FROM stream, params WHERE p < {B} * S)"""
    q["memory_context"] = f"""{grid},
wins AS (SELECT DISTINCT r, c // {T} AS w FROM grid WHERE c < S - 1),
mem AS (SELECT wn.r, wn.w, string_agg(CAST(g.id AS VARCHAR), ' ' ORDER BY g.c) AS memory FROM wins wn
        JOIN grid g ON g.r = wn.r AND g.c >= wn.w * {T} - {MEM} AND g.c < wn.w * {T} GROUP BY wn.r, wn.w)
SELECT wins.r, wins.w, COALESCE(mem.memory, '') AS memory FROM wins LEFT JOIN mem USING (r, w)"""
    for key, same, tl, mem, clamp in (("context_same_length", True, T, MEM, CLAMP), ("context_anchored", False, T, MEM, CLAMP), ("context_long", True, LONG_T, LONG_MEM, LONG_CLAMP)):
        lo = f"greatest(w * {tl} - m, c - {mem})" if same else f"w * {tl} - m"
        q[key] = f"""{grid},
qk AS (SELECT r, c, id, c // {tl} AS w, least({mem}, (c // {tl}) * {tl}) AS m,
              lag(c) OVER (PARTITION BY r, id ORDER BY c) AS prev FROM grid WHERE c < S - 1),
qv AS (SELECT r, w, c, prev, {lo} AS lo FROM qk)
SELECT r, w, CAST(sum(c - lo + 1) AS BIGINT) AS visible,
  CAST(sum(CASE WHEN prev >= lo THEN 1 ELSE 0 END) AS BIGINT) AS repeats,
  CAST(sum(CASE WHEN prev >= lo THEN least(c - prev, {clamp}) ELSE 0 END) AS BIGINT) AS dist_sum
FROM qv GROUP BY r, w"""
    q["embedding_lookup"] = f"""WITH {CORE}
SELECT p, id, round(CAST(embedding[1] AS DOUBLE) * sqrt(len(embedding)), 6) AS e0,
  round(CAST(embedding[64] AS DOUBLE) * sqrt(len(embedding)), 6) AS e63 FROM stream LEFT JOIN embeddings ON embeddings.vec_id = stream.id"""
    proj = [bin_projection(b) for b in range(3)]
    dots = {}
    for j in (0, BIN_DIM - 1):
        parts = ["CAST(embedding[%d] AS DOUBLE)" % (j + 1)]
        for b in (1, 2):
            parts.append("+".join(f"CAST(embedding[{i + 1}] AS DOUBLE) * ({proj[b][i][j]})" for i in range(BIN_DIM >> b)))
        dots[j] = f"CASE WHEN vec_id < {BIN_CUTS[1]} THEN {parts[0]} WHEN vec_id < {BIN_CUTS[2]} THEN {parts[1]} ELSE {parts[2]} END"
    q["embedding_bins"] = f"""WITH {CORE}
SELECT p, id, CAST(CASE WHEN id < {BIN_CUTS[1]} THEN 0 WHEN id < {BIN_CUTS[2]} THEN 1 ELSE 2 END AS BIGINT) AS bin,
  round(({dots[0]}) * sqrt({BIN_DIM}), 6) AS e0, round(({dots[BIN_DIM - 1]}) * sqrt({BIN_DIM}), 6) AS e15 FROM stream LEFT JOIN embeddings ON embeddings.vec_id = stream.id"""
    q["caller_metrics"] = "SELECT event_type, round(avg(value), 6) AS mean_loss, round(max(value) - min(value), 6) AS spread FROM events GROUP BY event_type"
    q["stream_encode"] = q["encode_unk"]
    q["stream_counts"] = f"WITH {LINES}, {COUNTS} SELECT sym, cnt FROM counts"
    fx = windows_sql(B, T, fixed=True)
    q["stream_segments"] = f"""WITH fw AS ({fx}), mc AS ({q["memory_context"]})
SELECT fw.r, fw.w, fw.inputs, fw.labels, mc.memory FROM fw JOIN mc ON fw.r = mc.r AND fw.w = mc.w"""
    q["stream_throughput"] = f"""WITH d AS (SELECT date_trunc('day', ts) AS ws, * FROM events),
g AS (SELECT ws, count(*) AS n, avg(value) AS mean_loss, max(event_id) - min(event_id) AS steps,
        epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM d GROUP BY ws),
mx AS (SELECT max(ts) AS mt FROM events)
SELECT CAST(epoch(ws) AS BIGINT) AS window_start, n, round(mean_loss, 6) AS mean_loss,
  round(CASE WHEN us > 0 THEN steps / (us / 1e6) END, 6) AS steps_per_sec,
  round(CASE WHEN us > 0 THEN steps / (us / 1e6) END * {B}, 6) AS examples_per_sec
FROM g, mx WHERE ws + INTERVAL 1 DAY <= mt - INTERVAL 1 HOUR"""
    return q
