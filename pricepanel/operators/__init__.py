"""DataFrame -> DataFrame operators. All are lazy except the explicit,
bounded size check in ``joins.maybe_broadcast``."""
