from tidepanel.commands import main

raise SystemExit(main())
