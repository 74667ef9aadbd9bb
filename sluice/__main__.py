from sluice.cli import main

main()
