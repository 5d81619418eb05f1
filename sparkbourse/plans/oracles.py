"""The registered queries as plain SQL over the test tables, for checking results."""

from __future__ import annotations



def made_id(*parts: str) -> str:
    """SQL of an id made from parts, each with its length before it."""
    return "sha256(" + " || ".join(f"length({p}) || ':' || {p}" for p in parts) + ")"


ORDERS = """o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS seq, n_name AS base, o_orderpriority AS quote,
    CAST(o_custkey AS VARCHAR) AS wallet,
    CASE WHEN o_orderkey % 2 = 0 THEN 'LIMIT_SELL' ELSE 'LIMIT_BUY' END AS side,
    CAST(ROUND(o_totalprice / 1000) AS BIGINT) AS price, CAST(1 + o_orderkey % 20 AS BIGINT) AS qty,
    CASE o_orderstatus WHEN 'O' THEN 'PROCESSED' WHEN 'F' THEN 'FILLED' ELSE 'CONFIRMED' END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

# All overlapping pairs, then the running quantity per taker.
MATCHES = ORDERS + """, pairs AS (
  SELECT t.id AS taker, m.id AS maker, t.seq AS tseq, t.base, t.quote, t.side, t.wallet AS taker_wallet,
    m.wallet AS maker_wallet, t.price AS taker_price, t.qty AS taker_qty, m.qty AS maker_qty, m.price AS price,
    COALESCE(SUM(m.qty) OVER (PARTITION BY t.id
      ORDER BY CASE WHEN t.side = 'LIMIT_SELL' THEN -m.price ELSE m.price END, m.id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM o t JOIN o m ON t.base = m.base AND t.quote = m.quote AND t.side <> m.side AND t.wallet <> m.wallet
    AND CASE WHEN t.side = 'LIMIT_SELL' THEN t.price <= m.price ELSE t.price >= m.price END
  WHERE t.status = 'CONFIRMED' AND m.status = 'PROCESSED'),
matches AS (
  SELECT *, LEAST(maker_qty, taker_qty - before) AS filled, """ + made_id("taker", "maker") + """ AS match_id
  FROM pairs WHERE before < taker_qty)"""



def settled() -> str:
    """Order processing of the clean log, one event of every market at a time.

    A market's state is the list of its orders and of its wallets' funds; a wallet trades in one market only. Step ``n``
    of ``run`` is the state after a market's n-th event, with the trades and the reason against the event.
    """
    made = made_id("CAST(seq AS VARCHAR)", "'o-' || id", "'cmd-' || id", "id")
    trade = "struct_pack(maker := m.id, wallet := m.wallet, there := m.qty, got := LEAST(m.qty, qty - m.ahead), price := m.price, ahead := m.ahead)"
    moves = """list_concat(
    CASE WHEN kind = 'SUBMIT' AND ok THEN [move(wallet, 0, CASE WHEN buys THEN price * qty ELSE 0 END, CASE WHEN buys THEN 1 ELSE 0 END, 0, CASE WHEN buys THEN 0 ELSE qty END, CASE WHEN buys THEN 0 ELSE 1 END)]
      WHEN kind = 'CANCEL' AND ok THEN [move(hit.wallet, 0, CASE WHEN hit.buys THEN -hit.price * hit.qty ELSE 0 END, CASE WHEN hit.buys THEN 1 ELSE 0 END, 0, CASE WHEN hit.buys THEN 0 ELSE -hit.qty END, CASE WHEN hit.buys THEN 0 ELSE 1 END)]
      WHEN kind = 'FILL' AND ok THEN [fill(hit.wallet, hit.buys, ask, hit.price, hit.price)]
      WHEN kind = 'WALLET' AND ok THEN [move(wallet, CASE WHEN on_base THEN amount ELSE 0 END, 0, CASE WHEN on_base THEN 1 ELSE 0 END, CASE WHEN on_base THEN 0 ELSE amount END, 0, CASE WHEN on_base THEN 0 ELSE 1 END)]
      ELSE [] END,
    list_transform(trades, lambda t: fill(wallet, buys, t.got, t.price, price)),
    list_transform(trades, lambda t: fill(t.wallet, NOT buys, t.got, t.price, t.price)))"""

    def move(wallet, b, bb, bt, q, qb, qt):
        return f"struct_pack(w := {wallet}, b := CAST({b} AS BIGINT), bb := CAST({bb} AS BIGINT), bt := {bt}, q := CAST({q} AS BIGINT), qb := CAST({qb} AS BIGINT), qt := {qt})"

    def fill(wallet, buys, got, price, limit):
        return move(
            wallet,
            f"CASE WHEN {buys} THEN -{got} * {price} ELSE {got} * {price} END", f"CASE WHEN {buys} THEN -{got} * {limit} ELSE 0 END", "1",
            f"CASE WHEN {buys} THEN {got} ELSE -{got} END", f"CASE WHEN {buys} THEN 0 ELSE -{got} END", "1",
        )

    moves = _called(_called(moves, "fill", fill), "move", move)

    def total(field: str) -> str:
        return f"w.{field} + COALESCE(list_sum(list_transform(list_filter(moves, lambda v: v.w = w.w), lambda v: v.{field})), 0)"

    funds = ", ".join(f"{c} := CAST({total(c)} AS BIGINT)" for c in ("b", "bb", "bt", "q", "qb", "qt"))
    return "WITH RECURSIVE " + ORDERS + f""", marked AS (
  SELECT *, {made} AS made, wallet || '/' || quote AS w FROM o),
lagged AS (
  SELECT *, LAG(made, 2) OVER m AS two, LAG(made) OVER m AS one, LAG(price) OVER m AS one_price, LAG(qty) OVER m AS one_qty,
    ROW_NUMBER() OVER m AS n FROM marked WINDOW m AS (PARTITION BY base, quote ORDER BY seq)),
ev AS (
  SELECT base, quote, n, seq, made, w AS wallet, side = 'LIMIT_BUY' AS buys, price, qty, 1 + seq % 4 AS ask, one_qty,
    CASE WHEN seq % 7 = 3 AND two IS NOT NULL THEN 'CANCEL' WHEN seq % 11 = 5 AND one IS NOT NULL THEN 'FILL'
      WHEN seq % 13 = 7 THEN 'WALLET' ELSE 'SUBMIT' END AS kind,
    CASE WHEN seq % 7 = 3 AND two IS NOT NULL THEN two ELSE one END AS target, seq % 3 = 0 AS on_base,
    CASE WHEN seq % 2 = 0 THEN 1 + seq % 50 ELSE -(1 + seq % 50) END AS amount
  FROM lagged),
start AS (
  SELECT base, quote, list(struct_pack(w := w, b := CAST(100 * (1 + c % 40) AS BIGINT), bb := CAST(0 AS BIGINT), bt := CAST(0 AS BIGINT),
    q := CAST(5 + c % 20 AS BIGINT), qb := CAST(0 AS BIGINT), qt := CAST(0 AS BIGINT))) AS funds
  FROM (SELECT DISTINCT base, quote, w, CAST(wallet AS BIGINT) AS c FROM marked) GROUP BY base, quote),
run AS (
  SELECT base, quote, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS VARCHAR) AS id,
    CAST([] AS STRUCT(id VARCHAR, wallet VARCHAR, buys BOOLEAN, price BIGINT, qty BIGINT, filled BIGINT, seq BIGINT)[]) AS book,
    CAST([] AS VARCHAR[]) AS gone, funds,
    CAST([] AS STRUCT(maker VARCHAR, wallet VARCHAR, there BIGINT, got BIGINT, price BIGINT, ahead BIGINT)[]) AS trades,
    CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS free, CAST(NULL AS BIGINT) AS open
  FROM start
  UNION ALL
  SELECT base, quote, n, seq, kind, id,
    CASE WHEN kind = 'SUBMIT' AND ok THEN list_append(after, struct_pack(id := id, wallet := wallet, buys := buys, price := price,
        qty := CAST(qty - taken AS BIGINT), filled := CAST(taken AS BIGINT), seq := seq))
      WHEN kind = 'CANCEL' AND ok THEN list_filter(book, lambda x: x.id <> id)
      WHEN kind = 'FILL' AND ok THEN list_transform(book, lambda x: struct_pack(id := x.id, wallet := x.wallet, buys := x.buys, price := x.price,
        qty := CAST(CASE WHEN x.id = id THEN x.qty - ask ELSE x.qty END AS BIGINT), filled := CAST(CASE WHEN x.id = id THEN x.filled + ask ELSE x.filled END AS BIGINT), seq := x.seq))
      ELSE book END,
    CASE WHEN kind = 'CANCEL' AND ok THEN list_append(gone, id) ELSE gone END,
    list_transform(funds, lambda w: struct_pack(w := w.w, {funds})),
    trades, reason, CASE WHEN reason = 'not enough funds' THEN free END, hit.qty
  FROM (
    SELECT *, {moves} AS moves, CAST(COALESCE(list_sum(list_transform(trades, lambda t: t.got)), 0) AS BIGINT) AS taken,
      list_transform(book, lambda x: struct_pack(id := x.id, wallet := x.wallet, buys := x.buys, price := x.price,
        qty := CAST(x.qty - COALESCE(list_sum(list_transform(list_filter(trades, lambda t: t.maker = x.id), lambda t: t.got)), 0) AS BIGINT),
        filled := CAST(x.filled + COALESCE(list_sum(list_transform(list_filter(trades, lambda t: t.maker = x.id), lambda t: t.got)), 0) AS BIGINT), seq := x.seq)) AS after
    FROM (
      SELECT *, CASE WHEN kind = 'SUBMIT' AND ok THEN list_transform(list_filter(ladder, lambda m: m.ahead < qty), lambda m: {trade}) ELSE [] END AS trades
      FROM (
        SELECT *, reason IS NULL AS ok, list_transform(makers, lambda m, i: struct_pack(id := m.id, wallet := m.wallet, price := m.price, qty := m.qty,
            ahead := CAST(COALESCE(list_sum(list_transform(makers[1:i - 1], lambda x: x.qty)), 0) AS BIGINT))) AS ladder
        FROM (
          SELECT *, CASE kind
              WHEN 'SUBMIT' THEN CASE WHEN free < CASE WHEN buys THEN price * qty ELSE qty END THEN 'not enough funds' END
              WHEN 'WALLET' THEN CASE WHEN amount < 0 AND free < -amount THEN 'not enough funds' END
              WHEN 'CANCEL' THEN CASE WHEN hit IS NULL THEN CASE WHEN list_contains(gone, id) THEN 'already cancelled' ELSE 'unknown order' END
                WHEN hit.qty = 0 THEN 'order is not open' END
              ELSE CASE WHEN ask > one_qty THEN 'more than the open quantity'
                WHEN hit IS NULL THEN CASE WHEN list_contains(gone, id) THEN 'order is not open' ELSE 'unknown order' END
                WHEN hit.qty = 0 THEN 'order is not open' WHEN ask > hit.qty THEN 'more than the open quantity' END END AS reason,
            list_sort(list_transform(list_filter(book, lambda x: x.buys <> buys AND x.wallet <> wallet AND x.qty > 0
              AND CASE WHEN buys THEN x.price <= price ELSE x.price >= price END),
              lambda x: struct_pack(fav := CASE WHEN buys THEN x.price ELSE -x.price END, id := x.id, wallet := x.wallet, price := x.price, qty := x.qty))) AS makers
          FROM (
            SELECT r.base, r.quote, e.n, e.seq, e.kind, CASE WHEN e.kind = 'SUBMIT' THEN e.made ELSE e.target END AS id, e.wallet, e.buys, e.price, e.qty,
              e.ask, e.one_qty, e.on_base, e.amount, r.book, r.gone, r.funds,
              list_filter(r.book, lambda x: x.id = e.target)[1] AS hit,
              list_transform(list_filter(r.funds, lambda f: f.w = e.wallet),
                lambda f: CASE WHEN e.kind = 'WALLET' AND e.on_base OR e.kind <> 'WALLET' AND e.buys THEN f.b - f.bb ELSE f.q - f.qb END)[1] AS free
            FROM run r JOIN ev e ON e.base = r.base AND e.quote = r.quote AND e.n = r.n + 1)))))),
ended AS (SELECT * FROM run QUALIFY ROW_NUMBER() OVER (PARTITION BY base, quote ORDER BY n DESC) = 1)
"""


def _called(text: str, name: str, make) -> str:
    """``text`` with every call ``name(a, b, ...)`` replaced by what ``make`` returns for its arguments."""
    while (at := text.find(f"{name}(")) >= 0:
        depth, parts, part, i = 0, [], "", at + len(name)
        while True:
            c = text[i]
            depth += (c == "(") - (c == ")")
            if depth == 0:
                break
            if c == "," and depth == 1:
                parts, part = [*parts, part], ""
            elif not (c == "(" and depth == 1):
                part += c
            i += 1
        text = text[:at] + make(*[p.strip() for p in [*parts, part]]) + text[i + 1 :]
    return text


def in_turn(tie: str) -> str:
    """Matching in which each taker meets the book the one before left: one step per taker of every market at once.

    ``tie`` orders makers at one price. Each market has a dummy row, so that a taker also acts on an empty book.
    """
    return "WITH RECURSIVE " + ORDERS + f""", t AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY base, quote ORDER BY seq) AS n FROM o WHERE status = 'CONFIRMED'),
run AS (
  SELECT CAST(0 AS BIGINT) AS n, FALSE AS is_match, base, quote, id, wallet, side, price, qty, seq,
    NULL::VARCHAR AS taker, NULL::VARCHAR AS taker_wallet, NULL::VARCHAR AS taker_side, NULL::BIGINT AS taker_price,
    NULL::BIGINT AS taker_qty, NULL::BIGINT AS taker_seq, CAST(0 AS BIGINT) AS filled, CAST(0 AS BIGINT) AS before
  FROM o WHERE status = 'PROCESSED'
  UNION ALL
  SELECT DISTINCT 0, FALSE, base, quote, '', '', 'NONE', 0, 1, 0, NULL, NULL, NULL, NULL, NULL, NULL, 0, 0 FROM t
  UNION ALL
  (WITH met AS (
     SELECT t.n AS tn, r.base, r.quote, r.id, r.wallet, r.side, r.price, r.qty, r.seq, t.id AS tid, t.wallet AS tw, t.side AS ts,
       t.price AS tp, t.qty AS tq, t.seq AS tseq,
       r.side <> 'NONE' AND r.side <> t.side AND r.wallet <> t.wallet
         AND CASE WHEN t.side = 'LIMIT_SELL' THEN t.price <= r.price ELSE t.price >= r.price END AS can
     FROM run r JOIN t ON t.base = r.base AND t.quote = r.quote AND t.n = r.n + 1 WHERE NOT r.is_match),
   placed AS (
     SELECT *, CAST(COALESCE(SUM(qty) OVER (PARTITION BY base, quote, can
       ORDER BY CASE WHEN ts = 'LIMIT_SELL' THEN -price ELSE price END, {tie}
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead FROM met),
   traded AS (SELECT *, CASE WHEN can THEN GREATEST(0, LEAST(qty, tq - ahead)) ELSE 0 END AS f FROM placed)
   SELECT tn, FALSE, base, quote, id, wallet, side, price, qty - f, seq, NULL, NULL, NULL, NULL, NULL, NULL, 0, 0
   FROM traded WHERE qty > f
   UNION ALL
   SELECT tn, TRUE, base, quote, id, wallet, side, price, qty, seq, tid, tw, ts, tp, tq, tseq, f, ahead FROM traded WHERE f > 0
   UNION ALL
   SELECT tn, FALSE, base, quote, tid, tw, ts, tp, CAST(tq - SUM(f) AS BIGINT), tseq, NULL, NULL, NULL, NULL, NULL, NULL, 0, 0
   FROM traded GROUP BY tn, base, quote, tid, tw, ts, tp, tq, tseq HAVING tq > SUM(f))),
matches AS (
  SELECT taker, id AS maker, taker_seq AS tseq, base, quote, taker_side AS side, taker_wallet, wallet AS maker_wallet,
    taker_price, taker_qty, qty AS maker_qty, price, before, filled FROM run WHERE is_match)"""


IN_TURN_OUT = """SELECT tseq AS seq, taker AS taker_id, maker AS maker_id, CAST(maker_qty AS DOUBLE) AS maker_qty,
  CAST(filled AS DOUBLE) AS qty_filled, CAST(price AS DOUBLE) AS price, CAST(before AS DOUBLE) AS qty_before FROM matches"""

FILLS = MATCHES + """, fills AS (
  SELECT """ + made_id("match_id", "'left'") + """ AS command_id, taker AS order_id, match_id AS cause_id, filled, price AS fill_price,
    taker_wallet AS wallet, side, taker_price AS limit_price, base, quote FROM matches
  UNION ALL
  SELECT """ + made_id("match_id", "'right'") + """, maker, match_id, filled, price, maker_wallet,
    CASE side WHEN 'LIMIT_SELL' THEN 'LIMIT_BUY' ELSE 'LIMIT_SELL' END, price, base, quote FROM matches)"""

FILL_COMMANDS = FILLS + """, caused AS (
  SELECT command_id, order_id, 'CREDIT' AS op, wallet,
    CASE side WHEN 'LIMIT_BUY' THEN quote ELSE base END AS asset,
    CASE side WHEN 'LIMIT_BUY' THEN filled ELSE filled * fill_price END AS amount, 0 AS release FROM fills
  UNION ALL
  SELECT command_id, order_id, 'RELEASE_AND_DEBIT', wallet,
    CASE side WHEN 'LIMIT_BUY' THEN base ELSE quote END,
    CASE side WHEN 'LIMIT_BUY' THEN filled * fill_price ELSE filled END,
    CASE side WHEN 'LIMIT_BUY' THEN filled * limit_price ELSE filled END FROM fills)"""

CHANGES = ORDERS + """, changes AS (
  SELECT id, base, quote, wallet, side, price, qty, seq * 3 AS seq, 'CONFIRMED' AS status, FALSE AS is_delete FROM o
  UNION ALL SELECT id, base, quote, wallet, side, price, qty, seq * 3 + 1, 'PROCESSED', FALSE FROM o
    WHERE status <> 'CONFIRMED'
  UNION ALL SELECT id, base, quote, wallet, side, price, qty, seq * 3 + 2, 'FILLED', FALSE FROM o
    WHERE status = 'FILLED'
  UNION ALL SELECT id, base, quote, wallet, side, price, qty, seq * 3 + 2, 'CANCELLED', TRUE FROM o
    WHERE status = 'PROCESSED' AND seq % 11 = 0)"""

ORDER_OUT = """id, base AS base_asset_id, quote AS quote_asset_id, wallet AS wallet_id, side AS order_type,
  CAST(price AS DOUBLE) AS price, CAST(qty AS DOUBLE) AS qty, 0.0::DOUBLE AS qty_filled, status"""

COMMANDS = """c AS (
  SELECT CAST(user_id AS VARCHAR) AS wallet, 'asset_' || (CAST(json_extract_string(props, '$.k') AS INT) % 3) AS asset,
    event_id AS seq,
    CASE event_type WHEN 'signup' THEN 'CREDIT' WHEN 'purchase' THEN 'DEBIT' WHEN 'click' THEN 'BLOCK'
      WHEN 'view' THEN 'RELEASE' ELSE 'RELEASE_AND_DEBIT' END AS op,
    CAST(ROUND(value * 100) AS BIGINT) AS amt FROM events)"""

# One step per command of a (wallet, asset), in order.
LEDGER = "WITH RECURSIVE " + COMMANDS + """, n AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY wallet, asset ORDER BY seq) AS rn FROM c),
f AS (
  SELECT wallet, asset, 0::BIGINT AS rn, NULL::BIGINT AS seq, NULL::VARCHAR AS op, 0::BIGINT AS amt, TRUE AS ok,
    0::BIGINT AS amount, 0::BIGINT AS blocked, 0::BIGINT AS was, 0::BIGINT AS tx
  FROM (SELECT DISTINCT wallet, asset FROM c)
  UNION ALL
  SELECT wallet, asset, rn, seq, op, amt, ok,
    amount + CASE WHEN NOT ok THEN 0 WHEN op = 'CREDIT' THEN amt WHEN op IN ('DEBIT', 'RELEASE_AND_DEBIT') THEN -amt
      ELSE 0 END,
    blocked + CASE WHEN NOT ok THEN 0 WHEN op = 'BLOCK' THEN amt WHEN op IN ('RELEASE', 'RELEASE_AND_DEBIT') THEN -amt
      ELSE 0 END,
    amount - blocked, tx + CASE WHEN ok THEN 1 ELSE 0 END
  FROM (SELECT n.wallet, n.asset, n.rn, n.seq, n.op, n.amt, f.amount, f.blocked, f.tx,
      NOT (n.op IN ('BLOCK', 'DEBIT') AND f.amount - f.blocked < n.amt) AS ok
    FROM f JOIN n ON n.wallet = f.wallet AND n.asset = f.asset AND n.rn = f.rn + 1)),
last AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY wallet, asset ORDER BY rn DESC) AS back FROM f),
ledger AS (SELECT wallet, asset, amount, blocked, tx FROM last WHERE back = 1)"""

# Order events of the log, with what makes a record unreadable.
LOG = ORDERS + """, placed AS (
  SELECT *, 'o-' || id AS event_id, seq % 97 AS h,
    CASE status WHEN 'CONFIRMED' THEN 'SUBMIT' WHEN 'FILLED' THEN 'CANCEL'
      ELSE CASE WHEN seq % 5 = 4 THEN 'MATCH' ELSE 'FILL' END END AS kind,
    CASE WHEN status = 'FILLED' THEN CAST(seq - seq % 3 AS VARCHAR) ELSE id END AS target,
    CAST(1 + seq % 15 AS BIGINT) AS fill_qty FROM o),
order_log AS (
  SELECT *, CASE WHEN h = 0 OR (h = 4 AND kind <> 'CANCEL') THEN 'unreadable JSON or number'
    WHEN h = 1 AND kind = 'SUBMIT' THEN 'unknown orderType in orderCommand.order'
    WHEN h = 1 AND kind = 'FILL' THEN 'unknown orderType in order'
    WHEN h = 1 AND kind = 'MATCH' THEN 'unknown orderType in ordersMatchCommand.leftOrder'
    END AS reason FROM placed),
""" + COMMANDS + """, wallet_log AS (
  SELECT *, CASE WHEN seq % 53 = 0 THEN 'unknown operation in walletCommand' END AS reason FROM c),
log AS (
  SELECT seq * 2 AS seq, event_id,
    CASE WHEN h = 2 THEN 'empty' WHEN kind = 'MATCH' THEN 'ordersMatchCommand' ELSE 'orderCommand' END AS content,
    CASE WHEN h <> 2 AND kind <> 'MATCH' THEN kind END AS command,
    CASE WHEN h <> 2 AND kind <> 'MATCH' THEN target END AS order_id,
    CASE WHEN h <> 2 AND kind = 'SUBMIT' THEN price END AS price,
    CASE WHEN h <> 2 AND kind IN ('SUBMIT', 'CANCEL', 'FILL') THEN CASE WHEN kind = 'FILL' THEN fill_qty ELSE 0 END
      END AS fill_qty,
    CASE WHEN h <> 2 AND kind IN ('FILL', 'MATCH') THEN base || '-' || quote END AS order_key,
    CASE WHEN h <> 2 AND kind IN ('SUBMIT', 'FILL') THEN wallet END AS wallet_key,
    NULL::VARCHAR AS operation, NULL::BIGINT AS amount, NULL::BIGINT AS amount_release
  FROM order_log WHERE reason IS NULL
  UNION ALL
  SELECT seq * 2 + 1, 'w-' || seq, 'walletCommand', NULL, NULL, NULL, NULL, NULL, wallet, op, amt,
    CASE WHEN op IN ('RELEASE', 'RELEASE_AND_DEBIT') THEN amt ELSE 0 END
  FROM wallet_log WHERE reason IS NULL),
commands AS (
  SELECT *, seq * 2 AS log_seq, 'cmd-' || id AS command_id FROM order_log
  WHERE reason IS NULL AND h <> 2 AND kind <> 'MATCH'),
cancels AS (
  SELECT k.log_seq AS seq, k.command_id, k.target, t.status, t.wallet, t.base, t.quote, t.side, t.price, t.qty,
    CASE WHEN t.id IS NULL THEN 'unknown order' WHEN t.status <> 'PROCESSED' THEN 'order is not open'
      WHEN k.log_seq > MIN(k.log_seq) OVER (PARTITION BY k.target) THEN 'already cancelled' END AS reason
  FROM commands k LEFT JOIN o t ON t.id = k.target WHERE k.kind = 'CANCEL'),
fill_checks AS (
  SELECT *, CASE WHEN fill_qty > qty THEN 'more than the open quantity' END AS refused FROM commands
  WHERE kind = 'FILL')"""


API = ORDERS + """, api AS (
  SELECT seq, 'SUBMIT' AS command, """ + made_id("'command'", "('r-' || id)") + """ AS command_id, """ + made_id("'order'", "('r-' || id)") + """ AS order_id
  FROM o WHERE status = 'CONFIRMED'
  UNION ALL SELECT seq, 'CANCEL', """ + made_id("'command'", "('r-' || id)") + """, id FROM o WHERE status = 'FILLED')"""


def _with(ctes: str, select: str) -> str:
    return (ctes if ctes.startswith("WITH ") else "WITH " + ctes) + "\n" + select


ASOF_SEQ = 20000
ORDER_ID = "1234"
BASE, QUOTE = "NATION_7", "1-URGENT"
MIN_BALANCE = 9000

ORACLES: dict[str, str] = {
    "match_snapshot": _with(
        MATCHES,
        """SELECT taker AS taker_id, maker AS maker_id, base AS base_asset_id, quote AS quote_asset_id,
  CAST(filled AS DOUBLE) AS qty_filled, CAST(price AS DOUBLE) AS price, CAST(before AS DOUBLE) AS qty_before
FROM matches""",
    ),
    "match_fills": _with(
        FILLS,
        """SELECT command_id, order_id, cause_id, 'FILL' AS command, wallet AS wallet_id, side AS order_type,
  CAST(filled AS DOUBLE) AS fill_qty, CAST(fill_price AS DOUBLE) AS fill_price FROM fills""",
    ),
    "trade_totals": _with(
        MATCHES,
        """SELECT taker AS taker_id, COUNT(*) AS matches, CAST(SUM(filled) AS DOUBLE) AS qty,
  CAST(SUM(filled * price) AS DOUBLE) AS notional FROM matches GROUP BY taker""",
    ),
    "order_book_l3": _with(ORDERS, f"SELECT {ORDER_OUT} FROM o"),
    "order_book_l2": _with(
        ORDERS,
        """SELECT base AS base_asset_id, quote AS quote_asset_id, side AS order_type, CAST(price AS DOUBLE) AS price,
  CAST(SUM(qty) AS DOUBLE) AS qty, COUNT(*) AS orders FROM o WHERE status = 'PROCESSED'
GROUP BY base, quote, side, price""",
    ),
    "markets": _with(
        ORDERS,
        """SELECT DISTINCT base AS base_asset_id, quote AS quote_asset_id, base || '-' || quote AS market FROM o""",
    ),
    "ticker": _with(
        MATCHES,
        """SELECT base || '-' || quote AS market, CAST(bid AS DOUBLE) AS best_bid, CAST(ask AS DOUBLE) AS best_ask,
  CAST(last AS DOUBLE) AS last, CAST(COALESCE(volume, 0) AS DOUBLE) AS volume, COALESCE(trades, 0) AS trades
FROM (SELECT base, quote, MAX(CASE WHEN status = 'PROCESSED' AND side = 'LIMIT_BUY' THEN price END) AS bid,
    MIN(CASE WHEN status = 'PROCESSED' AND side = 'LIMIT_SELL' THEN price END) AS ask FROM o GROUP BY base, quote)
LEFT JOIN (SELECT base, quote, SUM(filled) AS volume, COUNT(*) AS trades,
    ARG_MAX(price, tseq * 1000 + before) AS last FROM matches GROUP BY base, quote) USING (base, quote)""",
    ),
    "order_status": _with(ORDERS, f"SELECT {ORDER_OUT} FROM o WHERE id = '{ORDER_ID}'"),
    "orders_for_market": _with(
        ORDERS, f"SELECT {ORDER_OUT} FROM o WHERE base = '{BASE}' AND quote = '{QUOTE}'"
    ),
    "order_history": _with(
        CHANGES,
        """SELECT id, seq, LAG(status) OVER (PARTITION BY id ORDER BY seq) AS previous_status, status,
  CAST(qty AS DOUBLE) AS qty FROM changes""",
    ),
    "latest_by_key": _with(
        CHANGES,
        f"""SELECT {ORDER_OUT} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS back
  FROM changes) WHERE back = 1 AND NOT is_delete""",
    ),
    "snapshot_asof": _with(
        CHANGES,
        f"""SELECT {ORDER_OUT} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS back
  FROM changes WHERE seq <= {ASOF_SEQ}) WHERE back = 1 AND NOT is_delete""",
    ),
    "subscription_updates": _with(
        CHANGES,
        f"""SELECT id, seq, status, 'order/' || id || '/' || seq AS feed_id FROM changes
WHERE wallet IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > {MIN_BALANCE})""",
    ),
    "snapshot_plus_updates": _with(
        CHANGES,
        f"""SELECT id, status, 'snapshot' AS kind FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC)
  AS back FROM changes WHERE seq <= {ASOF_SEQ}) WHERE back = 1 AND NOT is_delete
UNION ALL SELECT id, status, 'update' FROM changes WHERE seq > {ASOF_SEQ}""",
    ),
    "wallet_ledger": _with(
        LEDGER,
        """SELECT wallet AS wallet_id, asset AS asset_id, CAST(amount AS DOUBLE) AS amount,
  CAST(blocked AS DOUBLE) AS blocked, tx AS tx_count FROM ledger""",
    ),
    "wallet_running_balance": _with(
        LEDGER,
        """SELECT wallet AS wallet_id, asset AS asset_id, seq, op AS operation, CAST(amount AS DOUBLE) AS balance,
  CAST(blocked AS DOUBLE) AS blocked_balance, tx AS tx_count FROM f WHERE rn > 0 AND ok""",
    ),
    "wallet_rejections": _with(
        LEDGER,
        """SELECT wallet AS wallet_id, asset AS asset_id, seq, op AS operation, CAST(amt AS DOUBLE) AS required,
  CAST(was AS DOUBLE) AS available FROM f WHERE NOT ok""",
    ),
    "wallet_balances": _with(
        LEDGER,
        """SELECT wallet AS wallet_id, asset AS asset_id, CAST(amount AS DOUBLE) AS amount,
  CAST(blocked AS DOUBLE) AS blocked, CAST(amount - blocked AS DOUBLE) AS available FROM ledger WHERE tx > 0""",
    ),
    "wallet_tx_count": _with(
        LEDGER, "SELECT wallet AS wallet_id, CAST(SUM(tx) AS BIGINT) AS tx_count FROM ledger GROUP BY wallet"
    ),
    "wallet_assets_map": _with(
        LEDGER,
        "SELECT wallet AS wallet_id, CAST(COUNT(*) FILTER (tx > 0) AS BIGINT) AS assets, "
        + ", ".join(
            f"CAST(COALESCE(MAX(CASE WHEN asset = 'asset_{i}' THEN {part} END), 0) AS DOUBLE) AS {part}_{i}"
            for i in range(3)
            for part in ("amount", "blocked")
        )
        + ", CAST(SUM(tx) AS BIGINT) AS tx_count FROM ledger GROUP BY wallet",
    ),
    "wallets_table": _with(
        LEDGER,
        """SELECT wallet AS wallet_id, asset AS asset_id, CAST(amount AS DOUBLE) AS amount, CAST(blocked AS DOUBLE) AS blocked
FROM ledger WHERE tx > 0""",
    ),
    "order_block_amounts": _with(
        ORDERS,
        """SELECT id, base || '-' || quote AS market,
  CASE side WHEN 'LIMIT_BUY' THEN 'LIMIT_SELL' ELSE 'LIMIT_BUY' END AS counter_side,
  CASE side WHEN 'LIMIT_BUY' THEN base ELSE quote END AS asset_to_block,
  CAST(CASE side WHEN 'LIMIT_BUY' THEN qty * price ELSE qty END AS DOUBLE) AS amount_to_block,
  CASE side WHEN 'LIMIT_BUY' THEN quote ELSE base END AS asset_to_credit FROM o""",
    ),
    "fill_wallet_commands": _with(
        FILL_COMMANDS,
        """SELECT command_id || '-' || op AS id, order_id AS cause_id, wallet AS wallet_id, asset AS asset_id,
  op AS operation, CAST(amount AS DOUBLE) AS amount, CAST(release AS DOUBLE) AS amount_release FROM caused""",
    ),
    "confirm_fills": _with(
        FILL_COMMANDS,
        """SELECT command_id, order_id FROM caused GROUP BY command_id, order_id
HAVING COUNT(DISTINCT op) = 2""",
    ),
    "fill_effects": _with(
        FILL_COMMANDS,
        """SELECT wallet AS wallet_id, asset AS asset_id,
  CAST(SUM(CASE op WHEN 'CREDIT' THEN amount ELSE -amount END) AS DOUBLE) AS amount,
  CAST(SUM(CASE op WHEN 'CREDIT' THEN 0 ELSE -release END) AS DOUBLE) AS blocked, COUNT(*) AS tx_count
FROM caused GROUP BY wallet, asset""",
    ),
    "apply_fills": in_turn("id")
    + """ SELECT o.id, CAST(o.qty - f.filled AS DOUBLE) AS qty, CAST(f.filled AS DOUBLE) AS qty_filled,
  CASE WHEN o.qty = f.filled THEN 'FILLED' ELSE 'PROCESSED' END AS status
FROM o JOIN (SELECT id, SUM(filled) AS filled FROM (SELECT taker AS id, filled FROM matches
  UNION ALL SELECT maker, filled FROM matches) GROUP BY id) f ON o.id = f.id""",
    "match_sequential": in_turn("id") + " " + IN_TURN_OUT,
    "match_sequential_by_age": in_turn("seq, id") + " " + IN_TURN_OUT,
    "decode_events": _with(
        LOG,
        """SELECT seq, event_id, content, command, order_id, CAST(price AS DOUBLE) AS price,
  CAST(fill_qty AS DOUBLE) AS fill_qty, operation, CAST(amount AS DOUBLE) AS amount,
  CAST(amount_release AS DOUBLE) AS amount_release FROM log""",
    ),
    "encode_events": _with(
        LOG,
        """SELECT seq, event_id, content, command, CAST(amount AS DOUBLE) AS amount FROM log""",
    ),
    "dead_letters": _with(
        LOG,
        """SELECT seq * 2 AS seq, reason FROM order_log WHERE reason IS NOT NULL
UNION ALL SELECT seq * 2 + 1, reason FROM wallet_log WHERE reason IS NOT NULL""",
    ),
    "route_events": _with(
        LOG,
        """SELECT seq, content, COALESCE(command = 'SUBMIT', FALSE) AS needs_order_processing,
  content = 'orderCommand' AS to_order_commands, content = 'walletCommand' AS to_wallet_commands FROM log""",
    ),
    "partition_keys": _with(
        LOG,
        """SELECT seq, order_key, wallet_key FROM log
WHERE order_key IS NOT NULL OR wallet_key IS NOT NULL OR command IS NOT NULL""",
    ),
    "unkeyed_events": _with(
        LOG,
        """SELECT seq, 'no partition key' AS reason FROM log
WHERE order_key IS NULL AND wallet_key IS NULL AND command IS NULL""",
    ),
    "validate_submit": _with(
        LOG,
        """SELECT log_seq AS seq, command_id, """ + made_id("CAST(log_seq AS VARCHAR)", "event_id", "command_id", "target") + """ AS order_id,
  base || '-' || quote AS market, wallet AS wallet_id, CAST(price AS DOUBLE) AS price, CAST(qty AS DOUBLE) AS qty
FROM commands WHERE kind = 'SUBMIT'""",
    ),
    "validate_cancel": _with(
        LOG,
        """SELECT seq, command_id, target AS order_id, wallet AS wallet_id, status FROM cancels WHERE reason IS NULL""",
    ),
    "cancel_rejects": _with(
        LOG, "SELECT seq, command_id, target AS order_id, reason FROM cancels WHERE reason IS NOT NULL"
    ),
    "validate_fill": _with(
        LOG,
        """SELECT log_seq AS seq, command_id, target AS order_id, CAST(fill_qty AS DOUBLE) AS fill_qty,
  CAST(qty AS DOUBLE) AS qty FROM fill_checks WHERE refused IS NULL""",
    ),
    "command_wallet_commands": _with(
        LOG,
        """SELECT command_id || '-BLOCK' AS id, """ + made_id("CAST(log_seq AS VARCHAR)", "event_id", "command_id", "target") + """ AS cause_id,
  wallet AS wallet_id, CASE side WHEN 'LIMIT_BUY' THEN base ELSE quote END AS asset_id, 'BLOCK' AS operation,
  CAST(CASE side WHEN 'LIMIT_BUY' THEN qty * price ELSE qty END AS DOUBLE) AS amount, 0.0::DOUBLE AS amount_release
FROM commands WHERE kind = 'SUBMIT'
UNION ALL
SELECT command_id || '-RELEASE', target, wallet, CASE side WHEN 'LIMIT_BUY' THEN base ELSE quote END, 'RELEASE', 0.0,
  CAST(CASE side WHEN 'LIMIT_BUY' THEN qty * price ELSE qty END AS DOUBLE) FROM cancels WHERE reason IS NULL
UNION ALL
SELECT command_id || '-CREDIT', target, wallet, CASE side WHEN 'LIMIT_BUY' THEN quote ELSE base END, 'CREDIT',
  CAST(CASE side WHEN 'LIMIT_BUY' THEN fill_qty ELSE fill_qty * price END AS DOUBLE), 0.0
FROM fill_checks WHERE refused IS NULL
UNION ALL
SELECT command_id || '-RELEASE_AND_DEBIT', target, wallet, CASE side WHEN 'LIMIT_BUY' THEN base ELSE quote END,
  'RELEASE_AND_DEBIT', CAST(CASE side WHEN 'LIMIT_BUY' THEN fill_qty * price ELSE fill_qty END AS DOUBLE),
  CAST(CASE side WHEN 'LIMIT_BUY' THEN fill_qty * price ELSE fill_qty END AS DOUBLE)
FROM fill_checks WHERE refused IS NULL""",
    ),
    "apply_cancel": _with(
        LOG,
        """SELECT target AS id, seq, 'CANCELLED' AS status, TRUE AS is_delete FROM cancels WHERE reason IS NULL
UNION ALL SELECT id, seq, status, FALSE FROM o WHERE id NOT IN (SELECT target FROM cancels WHERE reason IS NULL)""",
    ),
    "apply_submit": _with(
        LOG,
        """SELECT log_seq AS seq, """ + made_id("CAST(log_seq AS VARCHAR)", "event_id", "command_id", "target") + """ AS id, wallet AS wallet_id,
  CAST(price AS DOUBLE) AS price, CAST(qty AS DOUBLE) AS qty, 'CONFIRMED' AS status FROM commands WHERE kind = 'SUBMIT'""",
    ),
    "api_commands": _with(
        API,
        "SELECT command_id, order_id, order_id AS cause_id, command FROM api",
    ),
    "command_log": _with(API, "SELECT seq, order_id AS key, command_id, command FROM api"),
    "print_log": _with(
        ORDERS,
        """SELECT seq * 2 AS seq, 'o-' || id AS key FROM o
UNION ALL SELECT event_id * 2 + 1, 'w-' || event_id FROM events ORDER BY 1""",
    ),
    "merged_logs": _with(
        ORDERS,
        """SELECT seq * 2 AS seq, 'o-' || id AS key FROM o
UNION ALL SELECT event_id * 2 + 1, 'w-' || event_id FROM events
UNION ALL SELECT event_id, 'w-' || event_id FROM events""",
    ),
    "materialized_orders": _with(
        CHANGES,
        f"""SELECT {ORDER_OUT} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS back
  FROM changes) WHERE back = 1 AND NOT is_delete AND base = '{BASE}'""",
    ),
    "state_upsert": _with(
        CHANGES,
        """SELECT id, status FROM o WHERE status = 'PROCESSED'
  AND id NOT IN (SELECT id FROM changes WHERE status IN ('FILLED', 'CANCELLED'))
UNION ALL SELECT id, status FROM changes WHERE status = 'FILLED'""",
    ),
    "touch_wallets": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS wallet_id FROM events",
    "seeded_wallets": """SELECT CAST(c_custkey AS VARCHAR) AS wallet_id, a.asset_id, a.amount,
  0.0::DOUBLE AS blocked, CAST(0 AS BIGINT) AS tx_count
FROM customer JOIN nation ON c_nationkey = n_nationkey, LATERAL (
  SELECT n_name AS asset_id, c_acctbal * 100 AS amount
  UNION ALL SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']), 25.0) a""",
}
_BARE_FAULT = "CASE WHEN seq % 89 IN (5, 9) THEN 'unreadable JSON or number' WHEN seq % 89 = 7 THEN 'unknown {0}' END"
ORACLES["decode_commands"] = _with(
    ORDERS,
    f"""SELECT seq, reason, CASE WHEN reason IS NULL THEN 'cmd-' || id END AS command_id,
  CASE WHEN reason IS NULL THEN CASE WHEN seq % 2 = 0 THEN 'SUBMIT' ELSE 'CANCEL' END END AS command,
  CASE WHEN reason IS NULL THEN CAST(0 AS DOUBLE) END AS fill_qty,
  CASE WHEN reason IS NULL AND seq % 2 = 0 THEN CAST(CASE WHEN seq % 4 > 0 THEN qty ELSE 0 END AS DOUBLE) END AS qty
FROM (SELECT *, {_BARE_FAULT.format("command in orderCommand")} AS reason FROM o)""",
)
ORACLES["decode_orders"] = _with(
    ORDERS,
    f"""SELECT seq, reason, CASE WHEN reason IS NULL THEN id END AS id, CASE WHEN reason IS NULL THEN wallet END AS wallet_id,
  CASE WHEN reason IS NULL THEN CAST(price AS DOUBLE) END AS price,
  CASE WHEN reason IS NULL THEN CAST(CASE WHEN seq % 4 > 0 THEN qty ELSE 0 END AS DOUBLE) END AS qty,
  CASE WHEN reason IS NULL THEN CASE WHEN seq % 3 = 0 THEN status ELSE 'NEW' END END AS status
FROM (SELECT *, {_BARE_FAULT.format("orderType in order")} AS reason FROM o)""",
)
_SETTLED_ORDERS = """SELECT x.id, x.wallet AS wallet_id, CASE WHEN x.buys THEN 'LIMIT_BUY' ELSE 'LIMIT_SELL' END AS order_type,
  CAST(x.price AS DOUBLE) AS price, CAST(x.qty AS DOUBLE) AS qty, CAST(x.filled AS DOUBLE) AS qty_filled,
  CASE WHEN x.qty = 0 THEN 'FILLED' ELSE 'PROCESSED' END AS status, x.seq FROM (SELECT unnest(book) AS x FROM ended)"""
ORACLES["settle_orders"] = ORACLES["settle_streamed"] = settled() + _SETTLED_ORDERS
ORACLES["settle_wallets"] = settled() + """SELECT x.w AS wallet_id, base AS asset_id, CAST(x.b AS DOUBLE) AS amount, CAST(x.bb AS DOUBLE) AS blocked, x.bt AS tx_count
FROM (SELECT base, quote, unnest(funds) AS x FROM ended)
UNION ALL SELECT x.w, quote, CAST(x.q AS DOUBLE), CAST(x.qb AS DOUBLE), x.qt FROM (SELECT base, quote, unnest(funds) AS x FROM ended)"""
ORACLES["settle_rejections"] = settled() + "SELECT seq, reason, CAST(free AS DOUBLE) AS available FROM run WHERE reason IS NOT NULL"
ORACLES["settle_matches"] = settled() + """SELECT seq, id AS taker_id, t.maker AS maker_id, CAST(t.there AS DOUBLE) AS maker_qty, CAST(t.got AS DOUBLE) AS qty_filled,
  CAST(t.price AS DOUBLE) AS price, CAST(t.ahead AS DOUBLE) AS qty_before FROM (SELECT seq, id, unnest(trades) AS t FROM run)"""
# What an order went through: confirmed and resting, a trade on either side, a fill or a cancel.
ORACLES["settle_changes"] = settled() + """, steps AS (
  SELECT seq, id, -1 AS nth, 'CONFIRMED' AS status, NULL AS left_over FROM run WHERE kind = 'SUBMIT' AND reason IS NULL
  UNION ALL SELECT seq, id, -1, 'PROCESSED', NULL FROM run WHERE kind = 'SUBMIT' AND reason IS NULL
  UNION ALL SELECT r.seq, r.id, t.ahead, NULL, e.qty - t.ahead - t.got FROM (SELECT seq, id, unnest(trades) AS t FROM run) r JOIN ev e ON e.made = r.id
  UNION ALL SELECT seq, t.maker, t.ahead, NULL, t.there - t.got FROM (SELECT seq, unnest(trades) AS t FROM run)
  UNION ALL SELECT r.seq, r.id, -1, NULL, r.open - e.ask FROM run r JOIN ev e ON e.seq = r.seq WHERE r.kind = 'FILL' AND reason IS NULL
  UNION ALL SELECT seq, id, -1, 'CANCELLED', open FROM run WHERE kind = 'CANCEL' AND reason IS NULL)
SELECT s.seq, s.id, COALESCE(s.status, CASE WHEN left_over = 0 THEN 'FILLED' ELSE 'PROCESSED' END) AS status,
  CAST(COALESCE(left_over, e.qty) AS DOUBLE) AS qty, CAST(e.qty - COALESCE(left_over, e.qty) AS DOUBLE) AS qty_filled
FROM steps s JOIN ev e ON e.made = s.id AND e.kind = 'SUBMIT'"""
ORACLES["stream_ledger"] = ORACLES["stateful_ledger"] = ORACLES["wallet_ledger"]
ORACLES["stream_order_changes"] = ORACLES["subscription_updates"]
