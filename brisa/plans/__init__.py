"""Named analyses (``analyses``) and the registered query catalog (``catalog``)."""
