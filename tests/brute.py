"""Plain loops the operators are checked against on small inputs."""

from __future__ import annotations

from decimal import Decimal

COUNTER = {"LIMIT_BUY": "LIMIT_SELL", "LIMIT_SELL": "LIMIT_BUY"}


def candidates(taker: dict, book: list[dict], by_age: bool = False) -> list[dict]:
    buys = taker["orderType"] == "LIMIT_BUY"
    fitting = [
        m
        for m in book
        if m["status"] == "PROCESSED"
        and (m["baseAssetId"], m["quoteAssetId"]) == (taker["baseAssetId"], taker["quoteAssetId"])
        and m["orderType"] == COUNTER[taker["orderType"]]
        and m["walletId"] != taker["walletId"]
        and (m["price"] <= taker["price"] if buys else m["price"] >= taker["price"])
    ]
    return sorted(fitting, key=lambda m: (m["price"] if buys else -m["price"], m["seq"] if by_age else 0, m["id"]))


def match_one(taker: dict, book: list[dict], by_age: bool = False) -> list[tuple]:
    done, matches = Decimal(0), []
    for maker in candidates(taker, book, by_age):
        if done >= taker["qty"]:
            break
        filled = min(maker["qty"], taker["qty"] - done)
        matches.append((taker["id"], maker["id"], filled, maker["price"]))
        done += filled
    return matches


def match_each(takers: list[dict], book: list[dict]) -> list[tuple]:
    return [match for taker in takers for match in match_one(taker, book)]


def match_in_turn(takers: list[dict], book: list[dict], by_age: bool = False) -> list[tuple]:
    book = [dict(order) for order in book]
    all_matches = []
    for taker in sorted(takers, key=lambda t: t["seq"]):
        matches = match_one(taker, book, by_age)
        by_id = {order["id"]: order for order in book}
        left = taker["qty"]
        for _, maker, filled, _ in matches:
            by_id[maker]["qty"] -= filled
            left -= filled
        book = [order for order in book if order["qty"] > 0]
        if left > 0:
            book.append(dict(taker, qty=left, status="PROCESSED"))
        all_matches += matches
    return all_matches


def fold(commands: list[dict], start: dict | None = None) -> tuple[dict, list[int]]:
    """Balances per (wallet, asset) as (amount, blocked, accepted commands), and the seqs turned down."""
    balances, turned_down = dict(start or {}), []
    for c in sorted(commands, key=lambda c: c["seq"]):
        key = (c["walletId"], c["assetId"])
        amount, blocked, tx = balances.get(key, (Decimal(0), Decimal(0), 0))
        op, x, r = c["operation"], c["amount"], c["amountRelease"]
        if op in ("BLOCK", "DEBIT") and amount - blocked < x:
            turned_down.append(c["seq"])
            balances.setdefault(key, (amount, blocked, tx))
            continue
        if op == "CREDIT":
            amount += x
        elif op == "DEBIT":
            amount -= x
        elif op == "BLOCK":
            blocked += x
        elif op == "RELEASE":
            blocked -= r
        else:
            amount, blocked = amount - x, blocked - r
        balances[key] = (amount, blocked, tx + 1)
    return balances, turned_down
