"""DataFrame operators: filters, duplicate removal, keys, joins, checks, diffs."""
