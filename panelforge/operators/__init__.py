"""Panel operators (keys, columns, filters, joins, windows, reshape, profiles, geometry)."""
