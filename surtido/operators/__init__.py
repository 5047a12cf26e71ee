"""DataFrame operators. None of them starts a job; options are keyword arguments."""
