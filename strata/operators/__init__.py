"""DataFrame-to-DataFrame operators. They build plans and run nothing, unless they say so."""
