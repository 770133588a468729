from eventlake.cli import main

main()
