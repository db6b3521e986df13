"""Registered queries over the driver's tables (see ``catalog`` and ``oracle``)."""
