"""Where rows and control state come from and where records go."""
