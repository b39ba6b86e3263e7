"""Chinese-restaurant seating of many dishes at once, as ragged numpy arrays.

`owner` (sorted) has the dish of each table, `size` its customers. Restaurants
do not appear here: a dish in a restaurant is an entry of its own, and the
weight of a new table carries the restaurant and its parent.
"""

from __future__ import annotations

import numpy as np

# Steps of a sweep, and customers that a run of dishes holds in memory at once.
PARTS, RUN = 64, 1_000_000


class Finder:
    """Finds the table of a customer by its number; for tables that do not change meanwhile."""

    def __init__(self, size: np.ndarray, owner: np.ndarray, n: int):
        self.size, self.total = size, np.cumsum(size)
        tables = np.bincount(owner, minlength=n)
        first = np.cumsum(tables) - tables
        # Customers at the tables of smaller dishes.
        self.before = np.r_[0, self.total][first]

    def pick(self, rng: np.random.Generator, dishes: np.ndarray, customers: np.ndarray) -> np.ndarray:
        """The table of a random customer of each given dish."""
        at = self.before[dishes] + (rng.random(len(dishes)) * customers).astype(np.int64)
        return np.searchsorted(self.total, at, side="right")

    def join(self, rng: np.random.Generator, dishes: np.ndarray, customers: np.ndarray, discount: float) -> np.ndarray:
        """A table for a new customer of each dish, with weight (its customers - discount)."""
        out = np.empty(len(dishes), np.int64)
        todo = np.arange(len(dishes))
        while len(todo):
            table = self.pick(rng, dishes[todo], customers[todo])
            taken = rng.random(len(todo)) * self.size[table] >= discount
            out[todo[taken]] = table[taken]
            todo = todo[~taken]
        return out


def tidy(size, owner, new_owner) -> tuple[np.ndarray, np.ndarray]:
    """Empty tables leave, new ones with one customer come; `new_owner` is sorted."""
    kept = size > 0
    size, owner = size[kept], owner[kept]
    at = np.searchsorted(owner, new_owner)
    return np.insert(size, at, 1), np.insert(owner, at, new_owner)


def add(rng, size, owner, dishes, weight, discount: float):
    """Seat one more customer of each of the given different dishes; `weight` is that of a new table, per dish."""
    n = int(max(owner.max(initial=-1), dishes.max(initial=-1))) + 1
    customers = np.bincount(owner, weights=size, minlength=n).astype(np.int64)[dishes]
    tables = np.bincount(owner, minlength=n)[dishes]
    seated = customers - discount * tables
    fresh = rng.random(len(dishes)) * (weight[dishes] + seated) < weight[dishes]
    fresh |= customers == 0
    old = dishes[~fresh]
    size[Finder(size, owner, n).join(rng, old, customers[~fresh], discount)] += 1
    return tidy(size, owner, dishes[fresh])


def remove(rng, size, owner, dishes):
    """Let one random customer of each of the given different dishes leave."""
    n = int(owner.max(initial=-1)) + 1
    customers = np.bincount(owner, weights=size, minlength=n).astype(np.int64)[dishes]
    size[Finder(size, owner, n).pick(rng, dishes, customers)] -= 1
    return tidy(size, owner, np.empty(0, np.int64))


def sweep(rng, size, owner, weight, discount: float, moves: int):
    """Gibbs moves: of every dish with two or more customers, `moves` random ones (at most all) stand up and sit down anew."""
    n = len(weight)
    customers = np.bincount(owner, weights=size, minlength=n).astype(np.int64)
    for step in range(moves):
        dishes = np.flatnonzero(customers > max(step, 1))
        if not len(dishes):
            break
        size[Finder(size, owner, n).pick(rng, dishes, customers[dishes])] -= 1
        kept = size > 0
        size, owner = size[kept], owner[kept]
        left = customers[dishes] - 1
        own = weight[dishes]
        fresh = rng.random(len(dishes)) * (own + left - discount * np.bincount(owner, minlength=n)[dishes]) < own
        size[Finder(size, owner, n).join(rng, dishes[~fresh], left[~fresh], discount)] += 1
        size, owner = tidy(size, owner, dishes[fresh])
    return size, owner


def first_seating(rng, customers: np.ndarray, weight: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """A start near equilibrium: the expected number of tables, with the sizes that such tables have."""
    tables, seen = np.ones(len(customers)), np.ones(len(customers))
    while True:
        step = np.minimum(np.maximum(1.0, np.floor(seen / 8)), customers - seen)
        if not (step > 0).any():
            break
        tables += step * weight / (seen - discount * tables + weight)
        seen += step
    tables = np.clip(np.floor(tables + rng.random(len(tables))), 1, customers).astype(np.int64)
    owner = np.repeat(np.arange(len(customers)), tables)
    size = np.ones(len(owner), np.int64)
    growing = np.arange(len(owner))
    for s in range(1, 40):
        growing = growing[rng.random(len(growing)) >= discount / s]
        size[growing] += 1
    first = np.cumsum(tables) - tables
    # What is missing sits at the first table; a dish with too many starts with single tables.
    over = np.bincount(owner, weights=size, minlength=len(customers)) > customers
    size[over[owner]] = 1
    size[first] += customers - np.bincount(owner, weights=size, minlength=len(customers)).astype(np.int64)
    return size, owner


def sweep_all(rng, size, owner, weight, discount: float):
    """One Gibbs sweep: every customer of every dish with two or more stands up once and sits down anew.

    Dishes do not depend on each other here. They go in runs of at most RUN customers, a larger dish by itself.
    """
    n = len(weight)
    customers = np.bincount(owner, weights=size, minlength=n).astype(np.int64)
    tables = np.bincount(owner, minlength=n)
    run = (np.cumsum(customers) - customers) // RUN
    dish = np.r_[np.flatnonzero(np.r_[True, run[1:] != run[:-1]]), n] if n else np.zeros(1, np.int64)
    table = np.r_[0, np.cumsum(tables)]
    sizes, owners = [size[:0]], [owner[:0]]
    for a, b in zip(dish[:-1], dish[1:]):
        own = slice(table[a], table[b])
        new_size, new_owner = _sweep_run(rng, size[own], owner[own] - a, customers[a:b], weight[a:b], discount)
        sizes.append(new_size), owners.append(new_owner + a)
    return np.concatenate(sizes), np.concatenate(owners)


def _sweep_run(rng, size, owner, customers, weight, discount: float):
    """A sweep in PARTS steps. A dish with at most as many customers has one of them move at a time; of a larger one
    a PARTS-th moves side by side, each by the seats of those who stay, as in the rounds of different shards."""
    n, size = len(customers), size.astype(np.int64)
    seat = np.repeat(np.arange(len(size)), size)  # the table of each customer, by dish
    dish = np.repeat(np.arange(n), customers)
    first = np.cumsum(customers) - customers
    # A random order inside each dish, spread over the steps: dish, random bits and table sorted as one number.
    bits = len(size).bit_length()
    chance = 63 - bits - n.bit_length()
    key = (dish << (bits + chance)) | (rng.integers(0, 1 << chance, len(dish)) << bits) | seat
    key.sort()
    seat = (key & ((1 << bits) - 1)).astype(np.int32)
    dish = dish.astype(np.int32)
    step = ((np.arange(len(dish)) - np.repeat(first, customers)) * float(PARTS) / np.repeat(customers, customers)).astype(np.uint8)
    step[np.repeat(customers < 2, customers)] = PARTS  # alone: stays
    turn = np.argsort(step, kind="stable")
    ends = np.searchsorted(step[turn], np.arange(PARTS + 1))
    tables = np.bincount(owner, minlength=n)
    used = len(size)  # the arrays of tables have room beyond
    for k in range(PARTS):
        moving = turn[ends[k]:ends[k + 1]]
        if not len(moving):
            continue
        at, old = dish[moving], seat[moving]
        np.subtract.at(size, old, 1)
        empty = np.sort(old[size[old] == 0])
        empty = empty[np.diff(empty, prepend=-1) > 0]
        np.subtract.at(tables, owner[empty], 1)
        # `at` is sorted, so its dishes are its runs.
        start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        times = np.diff(np.r_[start, len(at)])
        dishes = at[start]
        chance_of_new = weight[dishes] / (weight[dishes] + (customers[dishes] - times) - discount * tables[dishes])
        fresh = rng.random(len(at)) < np.repeat(chance_of_new, times)
        todo = np.flatnonzero(~fresh)
        taken = old.copy()
        low, many = np.repeat(first[dishes], times), np.repeat(customers[dishes], times)
        while len(todo):  # a customer who stays shows the table, the discount is taken off by trying again
            other = low[todo] + (rng.random(len(todo)) * many[todo]).astype(np.int64)
            shown = seat[other]
            good = (step[other] != k) & (rng.random(len(todo)) * size[shown] >= discount)
            taken[todo[good]] = shown[good]
            todo = todo[~good]
        np.add.at(size, taken[~fresh], 1)
        opened = at[fresh]
        np.add.at(tables, opened, 1)
        # Tables that are empty now are used again, with their new dish; others are added.
        reused = empty[:len(opened)]
        more = len(opened) - len(reused)
        place = np.r_[reused, used + np.arange(more)]
        used += more
        if used > len(size):
            room = np.zeros(used - len(size) + len(size) // 8, np.int64)
            size, owner = np.r_[size, room], np.r_[owner, room]
        size[place], owner[place] = 1, opened
        taken[fresh] = place
        seat[moving] = taken
    kept = np.flatnonzero(size > 0)
    kept = kept[np.argsort(owner[kept], kind="stable")]
    return size[kept], owner[kept]
