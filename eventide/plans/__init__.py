"""Query plans: the reference's jobs composed from operators (``jobs``) and
their bindings to the driver's tables (``catalog``)."""
