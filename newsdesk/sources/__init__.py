"""Where rows come from and go to: tables, files, landed records, history, published documents."""
