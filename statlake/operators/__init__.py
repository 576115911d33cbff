"""DataFrame operators: decode, filters, paging, pivot, search, geometry, quality."""
