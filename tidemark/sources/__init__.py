"""Where rows come from and where records go."""
