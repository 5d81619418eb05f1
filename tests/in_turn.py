"""Order processing one event after the other, in plain Python, to compare with."""

from __future__ import annotations

from decimal import Decimal


class Exchange:
    """State and rejections after the events given to ``act``; events as the dicts that tests write to logs."""

    def __init__(self, balances, by_age=False):
        self.funds = {(w, a): [Decimal(x), Decimal(0)] for w, a, x in balances}
        self.orders, self.cancelled, self.refused, self.by_age = {}, set(), {}, by_age

    def _blocks(self, o):
        return (o["wallet"], o["base"]) if o["buys"] else (o["wallet"], o["quote"])

    def _cost(self, o, qty):
        return qty * o["price"] if o["buys"] else qty

    def _held(self, key):
        return self.funds.setdefault(key, [Decimal(0), Decimal(0)])

    def _asks(self, seq, key, amount, field, sign):
        amount_held, blocked = self.funds.get(key, (Decimal(0), Decimal(0)))
        if amount_held - blocked < amount:
            self.refused[seq] = ("not enough funds", amount_held - blocked)
            return False
        self._held(key)[field] += sign * amount
        return True

    def _fill(self, o, qty, price, copy=None):
        o["qty"] -= qty
        o["filled"] += qty
        like = copy or o
        got, paid = (qty, qty * price) if like["buys"] else (qty * price, qty)
        blocked_asset = like["base"] if like["buys"] else like["quote"]
        other = like["quote"] if like["buys"] else like["base"]
        self._held((like["wallet"], other))[0] += got
        entry = self._held((like["wallet"], blocked_asset))
        entry[0] -= paid
        entry[1] -= self._cost(like, qty)

    def submit(self, seq, order_id, wallet, side, price, qty, market):
        o = dict(id=order_id, wallet=wallet, buys=side == "LIMIT_BUY", price=Decimal(str(price)), qty=Decimal(str(qty)), filled=Decimal(0), base=market[0], quote=market[1], seq=seq)
        if not self._asks(seq, self._blocks(o), self._cost(o, o["qty"]), 1, 1):
            return
        self.orders[order_id] = o
        makers = [m for m in self.orders.values() if m["buys"] != o["buys"] and m["wallet"] != wallet and (m["base"], m["quote"]) == (o["base"], o["quote"]) and m["qty"] > 0]
        makers = [m for m in makers if (m["price"] <= o["price"] if o["buys"] else m["price"] >= o["price"])]
        for m in sorted(makers, key=lambda m: (m["price"] if o["buys"] else -m["price"], m["seq"] if self.by_age else 0, m["id"])):
            qty = min(m["qty"], o["qty"])
            if qty > 0:
                self._fill(m, qty, m["price"])
                self._fill(o, qty, m["price"])

    def cancel(self, seq, order_id):
        o = self.orders.get(order_id)
        if o is None or o["qty"] == 0:
            self.refused[seq] = ("already cancelled" if order_id in self.cancelled else "unknown order" if o is None else "order is not open", None)
            return
        self._held(self._blocks(o))[1] -= self._cost(o, o["qty"])
        self.cancelled.add(order_id)
        del self.orders[order_id]

    def fill(self, seq, order_id, qty, price, copy):
        o, qty = self.orders.get(order_id), Decimal(str(qty))
        if qty > copy["qty"]:
            self.refused[seq] = ("more than the open quantity", None)
        elif o is None:
            self.refused[seq] = ("order is not open" if order_id in self.cancelled else "unknown order", None)
        elif o["qty"] == 0:
            self.refused[seq] = ("order is not open", None)
        elif qty > o["qty"]:
            self.refused[seq] = ("more than the open quantity", None)
        else:
            self._fill(o, qty, Decimal(str(price)), copy)

    def wallet(self, seq, wallet, asset, operation, amount):
        amount, key = Decimal(str(amount)), (wallet, asset)
        if operation == "CREDIT":
            self._held(key)[0] += amount
        elif operation == "DEBIT":
            self._asks(seq, key, amount, 0, -1)
        elif operation == "BLOCK":
            self._asks(seq, key, amount, 1, 1)
        else:
            self._held(key)[1] -= amount
