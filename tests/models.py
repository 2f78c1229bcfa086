"""Plain Python models the operators are compared with."""


def first_arrivals(rows):
    """``rows``: (arrival, id, pair); gives the arrivals that stay."""
    ids, pairs, stays = set(), set(), []
    for arrival, key, pair in sorted(rows):
        if key not in ids and pair not in pairs:
            ids.add(key)
            pairs.add(pair)
            stays.append(arrival)
    return stays


def page_prefix(pages, last=10**6):
    """``pages``: (page, ok, entries, has_next) of one run; gives the pages read."""
    read = set()
    for number in range(1, last + 1):
        copies = [p for p in pages if p[0] == number and p[1]]
        if not copies:
            break
        read.add(number)
        if not any(entries > 0 and has_next for _, _, entries, has_next in copies):
            break
    return read
